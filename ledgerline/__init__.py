"""ledgerline: retail data operators and jobs built on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames built from Spark's own
SQL functions, so Catalyst plans the work and Tungsten runs it.  Sub-packages:

* ``functions``  column expressions (text, casts, nulls, dates, arrays, money)
* ``sources``    table and document readers (Parquet, JSON, XML payloads)
* ``operators``  upsert, dedupe, rollups, reconciliation, lookups, nesting
* ``plans``      the user-level jobs composed from the operators
* ``streaming``  incremental loads as Structured Streaming queries

The reference's row-level Python callables have no counterpart of their own;
each is replaced by built-in expressions: UD1 (row lambdas building keys) by
ST4/ST5 ``key_text``; UD2 (group ``mode`` lambdas) by AG8 ``mode_per_group``;
UD3 (link text, zone shift, age) by PR17/DT6/DT8 column functions; UD4
(``iterrows`` loops) by the JN15-JN17 lookups, MA1 decimals and AG11/AG12
grouping; UD5 (per-row error capture) by ``try_*`` casts with null results
routed to rejects frames.
"""

__version__ = "0.1.0"
