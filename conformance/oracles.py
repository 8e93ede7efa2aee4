"""The same queries as plain SQL over the test tables, for an independent engine."""

from __future__ import annotations

from conformance.bindings import RAW_COLUMNS, UNTYPED_COLUMNS, VOTE_OFFSET, VOTE_TAGS, aliased
from conformance.bindings import THRESHOLDS as T
from ratingloom.defaults import Z_95, ddl_names
from ratingloom.plans.summary import SUMMARY_SCHEMA

_Z = f"cast({Z_95!r} as double)"

# Raw catalogue rows, as derived in ``bindings.raw_catalog``.
RAW = f"""
stats as (
  select l_partkey,
         cast(sum(case when l_returnflag <> 'R' then 1 else 0 end) as bigint) kept,
         cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) returned,
         max_by(o_orderdate, l_orderkey) o_orderdate
  from lineitem join orders on l_orderkey = o_orderkey group by l_partkey),
raw0 as (
  select {", ".join(aliased(RAW_COLUMNS))},
    unnest(case when p_partkey % 20 = 0 then [1, 2] else [1] end) as ver
  from part left join stats on p_partkey = l_partkey),
raw as (
  select * replace (positive_ratings + (ver - 1) as positive_ratings) from raw0)"""

# The cleaned catalogue.
GAMES = f"""
dd as (
  select * from (
    select raw.*, row_number() over (partition by appid order by ver) rn
    from raw where appid is not null and name is not null) x where rn = 1),
c1 as (
  select appid, trim(name, ' ') as name, release_date, trim(developer, ' ') developer,
    trim(publisher, ' ') publisher, trim(platforms, ' ') platforms,
    trim(categories, ' ') categories, trim(genres, ' ') genres,
    trim(community_tags, ' ') community_tags, trim(owners, ' ') owners,
    greatest(coalesce(positive_ratings, 0), 0) positive_ratings,
    greatest(coalesce(negative_ratings, 0), 0) negative_ratings,
    case when price >= 0 then price end price
  from dd),
c2 as (
  select c1.*, positive_ratings + negative_ratings total_reviews,
    positive_ratings as p, cast(positive_ratings + negative_ratings as double) as n,
    {_Z} as z from c1),
c3 as (
  select c2.*, case when n > 0 then 100 * p / n end rating_pct,
    case when n > 0 then
      (p/n + z*z/(2*n) - z*sqrt(((p/n)*(1-p/n) + z*z/(4*n))/n)) / (1 + z*z/n) end wilson_score,
    cast(year(release_date) as int) release_year,
    case when price = 0 then 'Free' when price < 5 then 'Under 5' when price < 10 then '5-10'
         when price < 20 then '10-20' when price < 40 then '20-40' else '40+' end price_band,
    try_cast(nullif(regexp_extract(owners, '^([0-9]+)', 1), '') as bigint) owner_lower,
    try_cast(nullif(regexp_extract(owners, '([0-9]+)$', 1), '') as bigint) owner_upper
  from c2),
games as (
  select c3.* exclude (p, n, z), (owner_lower + owner_upper) / 2 owner_midpoint,
    release_date is null or price is null has_missing_core from c3)"""

LABELS = """
game_genres as (
  select distinct appid, trim(label) genre, total_reviews, rating_pct, wilson_score
  from (select *, unnest(string_split(genres, ';')) label from games) where trim(label) <> ''),
game_platforms as (
  select distinct appid, trim(label) platform, rating_pct
  from (select *, unnest(string_split(platforms, ';')) label from games) where trim(label) <> '')"""

VOTES = f"""
cells as (
  select user_id * 20 appid, event_type tag, cast(count(*) - {VOTE_OFFSET} as bigint) votes
  from events where event_type in ({", ".join(f"'{tag}'" for tag in VOTE_TAGS)}) group by all),
long_votes as (select * from cells where votes > 0),
tag_votes as (
  select appid, tag, votes, rating_pct from long_votes join games using (appid)),
all_tag_votes as (
  select appid, tag, votes, rating_pct from long_votes left join games using (appid))"""


# Of ``bindings.repeated_votes``: the cells of an item as often as its rows.
REPEATED_VOTES = """
repeated_votes as (
  select appid, tag, votes, rating_pct from tag_votes, generate_series(1, 6) copies (copy)
  where copy <= case when appid % 100 = 0 then 6 when appid % 40 = 0 then 2 else 1 end)"""


def _raw(body: str) -> str:
    return f"with {RAW}\n{body}"


def _games(body: str) -> str:
    return f"with {RAW},{GAMES}\n{body}"


def _labels(body: str) -> str:
    return f"with {RAW},{GAMES},{LABELS}\n{body}"


def _votes(body: str) -> str:
    return f"with {RAW},{GAMES},{VOTES}\n{body}"


def _repeated_votes(body: str) -> str:
    return f"with {RAW},{GAMES},{VOTES},{REPEATED_VOTES}\n{body}"


# Of the untyped catalogue the cells with text that is no number or date; a reader of CSV takes
# Java's type suffixes for numbers.
_BAD_CELLS = f"""select cast(appid as int) appid, "column", text from (
    select appid, 'price' as "column", {UNTYPED_COLUMNS['price']} as text from raw where appid % 50 = 0
    union all select appid, 'release_date', {UNTYPED_COLUMNS['release_date']} from raw where appid % 40 = 0)"""

CLEAN = """select appid, name, release_date, developer, publisher, platforms, categories, genres,
  community_tags, positive_ratings, negative_ratings, owners, price, total_reviews, rating_pct,
  wilson_score, release_year, price_band, owner_lower, owner_upper, owner_midpoint,
  has_missing_core from games"""

YEARLY = f"""select release_year, count(*) games, cast(sum(total_reviews) as bigint) total_reviews,
    round(avg(rating_pct), 2) mean_rating_pct
  from games where release_year between {T.first_year} and {T.last_year} group by release_year"""

GENRE = f"""select genre, count(*) games, cast(sum(total_reviews) as bigint) total_reviews,
    round(avg(rating_pct), 2) mean_rating_pct, round(avg(wilson_score) * 100, 2) mean_wilson_pct
  from game_genres group by genre having count(*) >= {T.min_label_items}"""

PLATFORM = """select platform, count(*) games, round(avg(rating_pct), 2) mean_rating_pct
  from game_platforms group by platform"""


def _band_report(median: str, source: str = "games") -> str:
    return f"""select price_band, count(*) games, round(avg(price), 2) mean_price,
    round(avg(rating_pct), 2) mean_rating_pct,
    cast({median} as bigint) median_reviews
  from {source} group by price_band"""


BANDS = _band_report("quantile_disc(total_reviews, 0.5)")
EXACT_BANDS = _band_report("trunc(median(total_reviews))")

TOP = f"""select appid, name, total_reviews, round(rating_pct, 2) rating_pct,
    round(wilson_score * 100, 2) wilson_pct, price
  from games where total_reviews >= {T.min_reviews}
  order by wilson_score desc nulls last, appid limit {T.top_items}"""

NUMBERED = f"""select cast(row_number() over (order by wilson_score desc, appid) as int) as position,
    appid, name, total_reviews, round(rating_pct, 2) rating_pct,
    round(wilson_score * 100, 2) wilson_pct, price
  from games where total_reviews >= {T.min_reviews}
  order by wilson_score desc, appid limit {T.top_items}"""

PUBLISHERS = f"""select publisher, count(*) games, cast(sum(total_reviews) as bigint) total_reviews,
    round(avg(wilson_score) * 100, 2) mean_wilson_pct
  from games where publisher is not null and publisher <> '' group by publisher
  having count(*) >= {T.min_publisher_items} and sum(total_reviews) >= {T.min_publisher_reviews}
  order by mean_wilson_pct desc nulls last, publisher limit {T.top_publishers}"""


def _top_tags(source: str) -> str:
    return f"""select tag, count(distinct appid) tagged_games,
    cast(sum(votes) as bigint) total_tag_votes, round(avg(rating_pct), 2) mean_rating_pct
  from {source} group by tag order by total_tag_votes desc, tag limit {T.top_tags}"""


ERA = f"""select release_year, era_rank, appid, name, total_reviews, rating_pct, wilson_score
  from (select *, cast(dense_rank() over (
          partition by release_year order by wilson_score desc nulls last) as int) era_rank
        from games where total_reviews >= {T.min_reviews} and release_year is not null) ranked
  where era_rank <= {T.era_ranks}"""

QUALITY = """select count(*) clean_rows, count(distinct appid) distinct_appids,
    cast(count_if(release_date is null) as bigint) missing_release_date,
    cast(count_if(price is null) as bigint) missing_price,
    cast(count_if(total_reviews = 0) as bigint) zero_review_games from games"""

SUMMARY = """summary as (select
    (select count(*) from raw) raw_rows,
    (select count(*) from games) clean_rows,
    (select count(distinct appid) from games) distinct_appids,
    (select count(*) from raw) - (select count(*) from (select distinct appid from raw))
      duplicate_appids_removed,
    (select count(*) from raw where release_date is null) missing_release_date_before,
    (select count(*) from games where release_date is null) missing_release_date_after,
    (select count(*) from games where price is null) missing_price_after,
    (select count(*) from games where total_reviews = 0) zero_review_games,
    (select cast(sum(positive_ratings) as bigint) from games) total_positive_ratings,
    (select cast(sum(negative_ratings) as bigint) from games) total_negative_ratings,
    (select round(100 * sum(positive_ratings) / cast(sum(total_reviews) as double), 2) from games)
      overall_weighted_positive_pct,
    (select round(median(rating_pct), 2) from games) median_game_rating_pct,
    (select cast(trunc(median(total_reviews)) as bigint) from games) median_reviews_per_game)"""


def _summary(body: str) -> str:
    return f"with {RAW},{GAMES},{SUMMARY}\n{body}"


def _check(name: str, violations: str) -> str:
    return f"""select '{name}' as "check", cast(violations as bigint) violations,
    violations = 0 passed from (select {violations} as violations)"""


_LIST = "['Free', 'Under 5', '5-10', '10-20', '20-40', '40+']"
_BY_BAND = f"list_position({_LIST}, price_band)"

RUN_REPORTS = {
    "data_quality": QUALITY,
    "yearly": YEARLY,
    "genre": GENRE,
    "platform": PLATFORM,
    "price_band": BANDS,
    "top_reliable": TOP,
    "publishers": PUBLISHERS,
    "era_champions": ERA,
    "top_tags": _top_tags("tag_votes"),
    "summary": "select 1 as one",
}
_COUNTS = " union all ".join(
    f"select '{name}' report, (select count(*) from ({text}) t) as \"rows\""
    for name, text in RUN_REPORTS.items()
)


def _run(body: str) -> str:
    return f"with {RAW},{GAMES},{LABELS},{VOTES},counts as ({_COUNTS})\n{body}"


# Key and value columns of the results of a run.
RUN_COLUMNS = {
    "data_quality": ([], "clean_rows distinct_appids missing_release_date missing_price zero_review_games"),
    "yearly": (["release_year"], "games total_reviews mean_rating_pct"),
    "genre": (["genre"], "games total_reviews mean_rating_pct mean_wilson_pct"),
    "platform": (["platform"], "games mean_rating_pct"),
    "price_band": (["price_band"], "games mean_price mean_rating_pct median_reviews"),
    "top_reliable": (["appid"], "name total_reviews rating_pct wilson_pct price"),
    "publishers": (["publisher"], "games total_reviews mean_wilson_pct"),
    "era_champions": (
        ["release_year", "era_rank", "appid"],
        "name total_reviews rating_pct wilson_score",
    ),
    "top_tags": (["tag"], "tagged_games total_tag_votes mean_rating_pct"),
    "summary": ([], " ".join(ddl_names(SUMMARY_SCHEMA))),
}


def _contents() -> str:
    """Every cell of every result of a run as text."""
    cells = []
    for report, (keys, columns) in RUN_COLUMNS.items():
        text = "select * from summary" if report == "summary" else RUN_REPORTS[report]
        key = "concat_ws('/', " + ", ".join(keys) + ")" if keys else "''"
        for column in columns.split():
            value = column if column == "name" else f"printf('%.6f', cast({column} as double))"
            if column != "name":
                value = f"coalesce({value}, 'null')"
            cells.append(
                f"select '{report}' report, {key} as key, '{column}' as \"column\", {value} as value from ({text}) t"
            )
    return " union all ".join(f"({cell})" for cell in cells)


ORACLES: dict[str, str] = {
    "land_raw": _raw(
        "select " + ", ".join(f"cast({c} as varchar) {c}" for c in RAW_COLUMNS) + " from raw"
    ),
    "read_catalog_csv": _raw(
        "select cast(appid as int) appid, " + ", ".join(list(RAW_COLUMNS)[1:]) + " from raw"
    ),
    "read_wide_votes": "select cast(user_id * 20 as int) appid, "
    + ", ".join(
        f"cast(count_if(event_type = '{tag}') - {VOTE_OFFSET} as bigint) as {tag}" for tag in VOTE_TAGS
    )
    + " from events group by user_id",
    "read_votes_by_header": "select cast(user_id * 20 as int) appid, "
    + ", ".join(
        f"cast(case when (user_id * 20 % 40 = 0) = {first} then count_if(event_type = '{tag}') - {VOTE_OFFSET} "
        f"else 0 end as bigint) as {tag}"
        for tag, first in (("click", "true"), ("error", "true"), ("purchase", "false"), ("signup", "false"))
    )
    + f", cast(count_if(event_type = 'view') - {VOTE_OFFSET} as bigint) as view from events group by user_id",
    "read_votes_folder": "select cast(user_id * 20 as int) appid, "
    + ", ".join(
        f"cast(count_if(event_type = '{tag}') - {VOTE_OFFSET} as bigint) as {tag}" for tag in VOTE_TAGS
    )
    + " from events group by user_id",
    "read_catalog_reordered": _raw(
        "select cast(appid as int) appid, " + ", ".join(list(RAW_COLUMNS)[1:]) + " from raw"
    ),
    "curated_roundtrip": _games(CLEAN),
    "curated_increment": _games(CLEAN),
    "tag_votes_bucketed": _votes("select * from tag_votes"),
    "result_csv_roundtrip": _games(YEARLY),
    "summary_json_roundtrip": _summary("select * from summary"),
    "clean_catalog": _games(CLEAN),
    "dedupe_catalog": _games("select appid, ver, positive_ratings from dd"),
    "dedupe_by_content": _games("select appid, name, positive_ratings from dd"),
    "coerce_types": _raw(
        "select appid, ver, "
        + ", ".join(
            f"try_cast({text} as {'date' if name == 'release_date' else 'double'}) {name}"
            for name, text in UNTYPED_COLUMNS.items()
        )
        + " from raw"
    ),
    "wilson_scores": _games(
        "select appid, positive_ratings, total_reviews, rating_pct, wilson_score from games"
    ),
    "wilson_null_at_zero": _games(
        "select appid, case when positive_ratings > 0 then wilson_score end wilson_score from games"
    ),
    "price_bands": _games(
        f"select appid, price, price_band, cast({_BY_BAND} - 1 as int) place from games"
    ),
    "owner_bounds": _games("select appid, owner_lower, owner_upper, owner_midpoint from games"),
    "missing_core": _games("select appid, has_missing_core from games"),
    "fill_blank_strings": _games(
        "select appid, publisher, coalesce(community_tags, '') community_tags from games"
    ),
    "display_names": """
        select doc_id, coalesce(label, 'App ' || text) chart_label,
               coalesce(label, 'Non-Latin title') table_label
        from (select doc_id, text,
                nullif(trim(regexp_replace(text, '[^\\x00-\\x7F]+', '', 'g'), ' ~-.'), '') as label
              from documents)""",
    "pretty_tags": """
        select tag, list_aggregate(list_transform(
                 regexp_extract_all(replace(tag, '_', ' '), '[a-z]+|[^a-z]+'),
                 lambda run: upper(run[1]) || lower(run[2:])), 'string_agg', '') as label,
               count(*) orders
        from (select replace(lower(o_orderpriority), ' ', '_') tag from orders) group by tag""",
    "formatted_kpis": _summary(
        """select total_positive_ratings + total_negative_ratings review_outcomes,
          round(overall_weighted_positive_pct - median_game_rating_pct, 2) weighted_minus_median,
          format('{:,}', clean_rows) games_text,
          format('{:,}', total_positive_ratings + total_negative_ratings) review_outcomes_text,
          printf('%.2f%%', overall_weighted_positive_pct) weighted_positive_text,
          printf('%.2f%%', median_game_rating_pct) median_rating_text,
          printf('%.2f-point', round(overall_weighted_positive_pct - median_game_rating_pct, 2))
            gap_text,
          format('{:,}', median_reviews_per_game) median_reviews_text
        from summary"""
    ),
    "formatted_price_bands": _games(
        f"""select price_band, format('{{:,}}', games) games_text,
          printf('GBP %.2f', mean_price) mean_price_text,
          printf('%.2f', mean_rating_pct) mean_rating_text,
          format('{{:,}}', median_reviews) median_reviews_text
        from ({EXACT_BANDS})"""
    ),
    "formatted_ranking": _games(
        f"""select position,
          coalesce(nullif(trim(regexp_replace(name, '[^\\x00-\\x7F]+', '', 'g'), ' ~-.'), ''),
                   'Non-Latin title') display_name,
          format('{{:,}}', total_reviews) reviews_text, printf('%.2f', rating_pct) rating_text,
          printf('%.2f', wilson_pct) wilson_text
        from ({NUMBERED}) where position <= 10"""
    ),
    "formatted_tags": _votes(
        f"""select upper(tag[1]) || lower(tag[2:]) as label, format('{{:,}}', tagged_games) games_text,
          format('{{:,}}', total_tag_votes) votes_text, printf('%.2f', mean_rating_pct) mean_rating_text
        from (select * from ({_top_tags("tag_votes")}) order by total_tag_votes desc, tag limit 3)"""
    ),
    "largest_genres": _labels(f"select * from ({GENRE}) order by total_reviews desc, genre limit 8"),
    "genre_bubble": _labels(
        f"""select *, 80 + 520 * sqrt(total_reviews / cast(max(total_reviews) over () as double))
            marker_size
        from (select * from ({GENRE}) order by total_reviews desc, genre limit 12)"""
    ),
    "uncertainty_sample": _games(
        """select appid, log10(total_reviews) log_reviews, rating_pct from games
        where total_reviews > 0
          and total_reviews <= (select quantile_cont(total_reviews, 0.995) from games)"""
    ),
    "explode_genres": _labels("select appid, genre from game_genres"),
    "explode_platforms": _labels("select appid, platform from game_platforms"),
    "game_genres": _labels("select * from game_genres"),
    "game_platforms": _labels("select * from game_platforms"),
    "joined_platforms": _labels("select * from game_platforms"),
    "unpivot_votes": _votes("select * from long_votes"),
    "tag_votes": _votes("select * from tag_votes"),
    "quality_report": _games(QUALITY),
    "missing_before": _raw(
        "select "
        + ", ".join(
            f"cast(count_if({c} is null) as bigint) missing_{c}"
            for c in ("release_date", "price", "genres", "publisher")
        )
        + " from raw"
    ),
    "run_summary": _summary("select * from summary"),
    "yearly_report": _games(YEARLY),
    "yearly_slice": _games(f"select * from ({YEARLY}) where release_year between 1997 and 1999"),
    "peak_year": _games(
        f"select release_year, games from ({YEARLY}) order by games desc, release_year limit 1"
    ),
    "genre_report": _labels(GENRE),
    "genre_min_games": _labels(f"select * from ({GENRE}) where games >= 250"),
    "platform_report": _labels(PLATFORM),
    "price_band_report": _games(BANDS),
    "price_band_exact": _games(EXACT_BANDS),
    "price_band_ordered": _games(
        f"""select cast(row_number() over (order by {_BY_BAND}) as int) as position, price_band,
          games, median_reviews from ({BANDS})"""
    ),
    "price_bands_complete": _games(
        f"""select price_band, games, mean_price, mean_rating_pct,
          coalesce(median_reviews, 0) median_reviews
        from (select unnest(['Free','Under 5','5-10','10-20','20-40','40-100','100+']) price_band)
        left join (
          {_band_report("trunc(median(total_reviews))",
            '''(select * replace (case when price >= 100 then '100+' when price >= 40 then '40-100'
                                       else price_band end as price_band)
                from games where price is not null)''')}) using (price_band)"""
    ),
    "best_price_band": _games(
        f"""select price_band, mean_rating_pct from ({BANDS})
        order by mean_rating_pct desc nulls last, {_BY_BAND} limit 1"""
    ),
    "publisher_report": _games(PUBLISHERS),
    "shared_reports": _games(
        f"""select 'yearly' as report, cast(release_year as varchar) as "key", games, mean_rating_pct,
          cast(null as double) as other from ({YEARLY})
        union all select 'band', price_band, games, mean_rating_pct, mean_price from ({BANDS})
        union all select 'publisher', publisher, games, null, mean_wilson_pct from ({PUBLISHERS})"""
    ),
    "sketched_medians": _games(
        """select price_band, count(*) games, true as within from games
        where release_year between 1996 and 1998 group by price_band"""
    ),
    "sketched_items_by_genre": _labels(
        """select genre, count(*) games, count(distinct appid) items, count(distinct publisher) publishers,
          true as within
        from game_genres join (select appid, publisher, release_year from games) using (appid)
        where release_year between 1996 and 1998 group by genre"""
    ),
    "top_tags": _votes(_top_tags("tag_votes")),
    "top_tags_left": _votes(_top_tags("all_tag_votes")),
    "top_tags_repeated": _repeated_votes(_top_tags("repeated_votes")),
    "tag_votes_repeated": _repeated_votes("select * from repeated_votes"),
    "full_run_repeated_votes": _repeated_votes(_top_tags("repeated_votes")),
    "top_tags_unique": _votes(_top_tags("tag_votes")),
    "top_tags_left_unique": _votes(_top_tags("all_tag_votes")),
    "top_tags_many_columns": _games(
        """select tag, count(*) tagged_games, cast(sum(votes) as bigint) total_tag_votes,
          round(avg(rating_pct), 6) mean_rating
        from (select p_partkey // 20 * 20 appid, p_type tag, sum(p_size) votes from part group by all)
        left join games using (appid) where votes > 0 group by tag"""
    ),
    "top_tags_long": _votes(_top_tags("tag_votes")),
    "top_tags_wide": _votes(_top_tags("all_tag_votes")),
    "top_reliable": _games(TOP),
    "top_reliable_numbered": _games(NUMBERED),
    "top_n_of_result": _games(f"select * from ({TOP}) order by wilson_pct desc, appid limit 8"),
    "era_champions": _games(ERA),
    "sql_yearly": _games(YEARLY),
    "sql_genre": _labels(GENRE),
    "sql_price_band": _games(BANDS),
    "sql_top_reliable": _games(TOP),
    "sql_platform": _labels(PLATFORM),
    "sql_publishers": _games(PUBLISHERS),
    "sql_top_tags": _votes(_top_tags("tag_votes")),
    "sql_wilson_function": _games("select appid, wilson_score from games"),
    "check_unique_key": _games(
        _check("unique_key", "(select count(*) - count(distinct appid) from games)")
    ),
    "check_totals": _games(
        _check(
            "consistent_totals",
            """(select case when sum(positive_ratings) + sum(negative_ratings) = sum(total_reviews)
                       then 0 else 1 end
              + case when 100 * sum(positive_ratings) / sum(total_reviews) > 0
                      and 100 * sum(positive_ratings) / sum(total_reviews) <= 100 then 0 else 1 end
            from games)""",
        )
    ),
    "check_ranking_order": _games(
        _check(
            "ranking_order",
            f"""(select count_if(wilson_score > before) from (
              select wilson_score, lag(wilson_score) over (order by wilson_score desc, appid) before
              from games where total_reviews >= {T.min_reviews}
              order by wilson_score desc, appid limit {T.top_items}))""",
        )
    ),
    "check_eligible": _games(
        _check("meets_threshold", f"(select count_if(total_reviews < {T.min_reviews}) from ({TOP}))")
    ),
    "check_wilson_bound": _games(
        _check(
            "lower_bound_holds",
            "(select count_if(wilson_score * 100 > rating_pct + 1e-9) from games)",
        )
    ),
    "check_band_total": _games(
        _check(
            "group_total",
            f"abs((select sum(games) from ({BANDS})) - (select count(*) from games))",
        )
    ),
    "check_band_domain": _games(
        _check(
            "label_domain",
            f"""(select count(*) from (select unnest({_LIST}) b) where b not in (
                select price_band from ({BANDS})))
              + (select count(*) from ({BANDS}) where {_BY_BAND} is null)""",
        )
    ),
    "check_band_order": _games(
        _check(
            "label_order",
            f"""(select count_if(place is distinct from listed) from (
              select row_number() over (order by {_BY_BAND}) place, {_BY_BAND} listed
              from ({BANDS})))""",
        )
    ),
    "check_unique_key_broken": _raw(
        _check(
            "unique_key", "(select count(*) from (select appid from raw group by appid having count(*) > 1))"
        )
    ),
    "check_totals_broken": _games(
        _check(
            "consistent_totals",
            """(select case when sum(positive_ratings) + sum(negative_ratings) = sum(total_reviews + 1)
                       then 0 else 1 end from games)""",
        )
    ),
    "check_ranking_order_broken": _games(
        _check(
            "ranking_order",
            f"""(select count_if(wilson_score > before) from (
              select wilson_score, lag(wilson_score) over (order by wilson_score, appid) before
              from games where total_reviews >= {T.min_reviews}
              order by wilson_score, appid limit {T.top_items}))""",
        )
    ),
    "check_eligible_broken": _games(
        _check("meets_threshold", f"(select count_if(total_reviews < {T.min_reviews}) from games)")
    ),
    "check_wilson_bound_broken": _games(
        _check(
            "lower_bound_holds",
            "(select count_if(rating_pct > wilson_score * 100 + 1e-9) from games)",
        )
    ),
    "check_band_total_broken": _games(
        _check("group_total", "(select count(*) from games where price_band = 'Free')")
    ),
    "check_band_domain_broken": _games(_check("label_domain", "2")),
    "check_band_order_broken": _games(
        _check(
            "label_order",
            f"""(select count_if(place is distinct from listed) from (
              select row_number() over (order by {_BY_BAND} desc) place, {_BY_BAND} listed
              from ({BANDS})))""",
        )
    ),
    "full_run_contents": f"with {RAW},{GAMES},{LABELS},{VOTES},{SUMMARY}\n{_contents()}",
    "run_checks": """select unnest(['unique_key', 'consistent_totals', 'ranking_order', 'meets_threshold',
        'lower_bound_holds', 'group_total', 'label_domain', 'label_order']) as "check",
      cast(0 as bigint) violations, true passed""",
    "full_run_reports": _run("select * from counts"),
    "rejected_cells": _raw(f"select * from ({_BAD_CELLS})"),
    "full_run_audit": _raw(
        f'select "column", count(*) cells, count(*) listed from ({_BAD_CELLS}) group by "column"'
    ),
    "run_manifest": _run(
        """select report, "rows", true as whole from counts
        union all select 'curated', count(*), true from games"""
    ),
    "rerun_idempotent": _run('select report, "rows", true as unchanged from counts'),
}
