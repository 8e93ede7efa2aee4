"""Nulls, empty and long texts, repeated rows, empty tables, clashing names: every operator."""

import json

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import bpe, decontaminate, langid, linededup, minhash, pu, quality, reputation, sharding, toolchat
from ratingloom.llm.queries import QUERIES
from tests.llm.conftest import CLASHING, ODD_ROWS, sentence

KINDS = ("odd_docs", "no_docs", "clashing_docs")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def bench(spark):
    rows = [(1, sentence(1, 12)), (1, sentence(1, 12)), (None, sentence(3, 10)), (3, None), (4, ""), (5, "x")]
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "decontaminate": lambda s, d: decontaminate.find_hits(d, bench(s)),
    "clean": lambda s, d: decontaminate.clean_documents(d, bench(s)),
    "no_benchmark": lambda s, d: decontaminate.find_hits(d, bench(s).limit(0)),
    "quality": lambda s, d: quality.judge(d),
    "quality_keep": lambda s, d: quality.keep(d),
    "langid": lambda s, d: d.select(langid.predicted(d, langid.fit(d)).alias("p")),
    "reputation": lambda s, d: reputation.judge_urls(
        d.withColumnRenamed("doc_id", "page_id").withColumn("url", F.concat(F.lit("http://A.b/"), "text")),
        [reputation.UrlRule("b", "/x", "allow")],
        F.col("lang") == "de",
    ),
    "pu": lambda s, d: d.select(pu.scored(d, pu.fit(d, d.where("lang = 'en'").select("doc_id"))).alias("s")),
    "bpe": lambda s, d: bpe.encode_documents(d, RANKS, public_tokenizers.PATTERN),
    "sharding": lambda s, d: sharding.shard(d, 5),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "minhash_keep": lambda s, d: minhash.keep_one(d),
    "linededup": lambda s, d: linededup.dedup_lines(d),
}
SAME_ROWS = set(OPERATORS) - {"clean", "quality_keep", "minhash_keep"}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_tables(spark, request, name, kind):
    docs = request.getfixturevalue(kind)
    result = OPERATORS[name](spark, docs)
    assert len({c.lower() for c in result.columns}) == len(result.columns)
    rows = result.collect()
    if kind == "no_docs":
        assert rows == []
    elif name in SAME_ROWS:
        assert len(rows) == len(ODD_ROWS)
    else:
        assert result.columns == docs.columns and 0 < len(rows) <= len(ODD_ROWS)
    if kind == "clashing_docs" and name in ("clean", "quality_keep", "minhash_keep"):
        assert all(r[c] == c for r in rows for c in CLASHING)


def test_toolchat_odd(spark):
    calls = spark.createDataFrame(
        [
            (1, 1, "a", "f", '{"n": 1}', ["b"], None),
            (1, 3, "b", "f", '{"n": "1", "m": 2}', ["a"], None),
            (1, 5, "c", "f", "no json", [], None),
            (1, 7, "c", "f", "[1]", None, None),
            (2, 1, "d", None, None, ["gone"], None),
            (2, 2, "e", "f", '{"n":2}', ["d", "d"], "say"),
            (2, 2, "e", "f", '{"n":2}', ["d", "d"], "say"),
            (None, 1, "d", "f", "{}", ["d"], None),
            (3, None, None, None, None, None, None),
        ],
        "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, content string",
    )
    results = spark.createDataFrame(
        [(2, 3, "e", "é"), (2, 4, "zz", "?"), (3, 1, None, None), (1, 9, "c", "")],
        "conv_id long, turn long, call_id string, content string",
    )
    messages = spark.createDataFrame([(1, 0, None, None)], "conv_id long, turn long, role string, content string")
    schemas = {"f": {"n": ("integer", True)}}
    rows = toolchat.format_messages(messages, calls, results, schemas).collect()
    assert len(rows) == 14
    by = {(r.conv_id, r.turn, r.kind, r.call_id): r for r in rows}
    assert by[1, 1, "call", "a"].status == "cycle" and by[1, 1, "call", "a"].level is None
    assert by[1, 3, "call", "b"].arguments_error == "n is not integer; unexpected m"
    assert by[1, 5, "call", "c"].arguments_error == "not JSON" and by[1, 5, "call", "c"].status == "linked"
    assert by[1, 7, "call", "c"].status == "repeated" and by[1, 7, "call", "c"].arguments_error == "not an object"
    assert by[2, 1, "call", "d"].arguments_error == "unknown tool" and by[2, 1, "call", "d"].level == 0
    assert (by[2, 2, "call", "e"].level, by[2, 2, "call", "e"].status) == (1, "linked")
    assert by[None, 1, "call", "d"].status == "cycle"
    assert by[3, None, "call", None].status == "unanswered"
    assert by[2, 4, "result", "zz"].status == "orphan" and by[3, 1, "result", None].status == "orphan"
    assert by[2, 3, "result", "e"].json == '{"content":"é","role":"tool","tool_call_id":"e"}'
    none = toolchat.format_messages(messages.limit(0), calls.limit(0), results.limit(0), schemas)
    assert none.collect() == []


STRICT = [
    ('{"n":"\\ud800"}', "not JSON"),
    ("[" * 100_000, "not JSON"),
    ('{"n":NaN}', "not JSON"),
    ('{"n":-Infinity}', "not JSON"),
    ('{"n":1e400}', "not JSON"),
    ('{"n":1,"n":2}', "not JSON"),
    ('{"n":' + "9" * 5000 + "}", "not JSON"),
    ('{"n":1.0}', ""),
    ('{"n":true}', "n is not integer"),
    ('{"n":1,"o":{"p":1,"p":1}}', "not JSON"),
]
NESTED = {
    "type": "object",
    "properties": {
        "a": {
            "type": "object",
            "properties": {"b": {"type": "array", "items": {"type": "integer", "minimum": 1}}},
            "required": ["b"],
        },
        "k": {"enum": ["x", "y", 1]},
        "z": {"type": ["string", "null"]},
    },
    "additionalProperties": False,
}
RULES = [
    ('{"a":{"b":[1,2]},"k":"x","z":null}', ""),
    ('{"a":{"b":[1,0,"q"]},"k":"w","v":1}', 'a.b[1] is below 1; a.b[2] is not integer; k is not one of ["x","y",1]; unexpected v'),
    ('{"a":{}}', "missing a.b"),
    ('{"a":[],"z":1}', "a is not object; z is not string or null"),
]


def test_arguments_are_strict_json_of_any_size(spark):
    """Broken Unicode, depth, NaN, repeated keys, nested rules, long texts and clashing columns."""
    cases = [(k, "f", a, e) for k, (a, e) in enumerate(STRICT)]
    cases += [(100 + k, "g", a, e) for k, (a, e) in enumerate(RULES)]
    cases.append((200, "h", json.dumps({"t": "\u00e9" * 300_000}), ""))
    calls = spark.createDataFrame(
        [(1, k, f"c{k}", name, a, [], None) for k, name, a, _ in cases],
        "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, content string",
    )
    clash = [F.lit(c).alias(c) for c in ("level", "node", "answered", "first_turn", "status", "kind", "json", "role")]
    results = calls.selectExpr("conv_id", "turn", "call_id", "content")
    messages = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, content string")
    schemas = {"f": {"n": ("integer", True)}, "g": NESTED, "h": {"t": ("string", True)}}
    found = toolchat.format_messages(
        messages.select("*", *clash[:-1]), calls.select("*", *clash), results.select("*", *clash), schemas
    ).collect()
    errors = {r.turn: r.arguments_error for r in found if r.kind == "call"}
    assert errors == {k: e for k, _, _, e in cases}
    for r in found:
        json.loads(r.json, parse_constant=lambda _: pytest.fail("no JSON"))
        r.json.encode()


def test_clean_documents_with_clashing_columns(spark, odd_docs):
    docs = odd_docs.select("*", *[F.lit(n).alias(n) for n in ("doc_key_hit", "hit_key", "hit_id", "gone_key_id", "gone_id")])
    assert decontaminate.clean_documents(docs, bench(spark)).columns == docs.columns
    assert minhash.keep_one(docs).columns == docs.columns


def test_toolchat_long_chain(spark):
    calls = spark.range(12).selectExpr(
        "1L AS conv_id", "12 - id AS turn", "concat('c', id) AS call_id", "'f' AS name", "'{}' AS arguments",
        "array(concat('c', id - 1)) AS depends_on", "cast(null AS string) AS content",
    )
    results = calls.selectExpr("conv_id", "turn", "call_id", "content").limit(0)
    messages = spark.createDataFrame([], "conv_id long, turn long, role string, content string")
    rows = toolchat.format_messages(messages, calls, results, {"f": {}}).collect()
    assert {r.call_id: r.level for r in rows} == {f"c{k}": k for k in range(12)}


def test_all_are_registered():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
