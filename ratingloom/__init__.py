"""Catalogue and rating analytics on Spark.

Every public function takes and returns a ``DataFrame`` or a ``Column``; column
names, thresholds and band edges are arguments with documented defaults.

* ``functions``  column builders: measures, coercions, presentation text
* ``operators``  DataFrame operators: cleaning, reshaping, ranking, quantiles, checks
* ``sources``    readers, writers, named views, shared scratch space
* ``plans``      reports, run summary, SQL reports, the whole run
"""

__version__ = "0.1.0"
