"""Time the headline jobs; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every time covers
planning, all jobs of a search and fetching its result. The query table of 100
rows holds two-word phrases taken from the documents themselves.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from checks.inputs import corpus, query_table, table
from tagseek.functions.tokens import words
from tagseek.operators import match, spelling
from tagseek.params import SearchParams
from tagseek.plans.search import exact_search, phonetic_search, search
from tagseek.session import fresh_path, local_session, settle
from tagseek.sources.store import save_index, total_bytes

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STRICT = SearchParams(slop=0)


def phrases(spark, n: int):
    """Up to ``n`` distinct two-word phrases, every document giving some."""
    spelled = table(spark, SF_DIR, "documents").select("doc_id", words(F.col("text")).alias("w")).where(F.size("w") > 40)
    pairs = spelled.select(F.explode(F.sequence(F.lit(0), F.lit(38), F.lit(2))).alias("i"), "w").select(
        F.concat_ws(" ", F.get("w", F.col("i")), F.get("w", F.col("i") + 1)).alias("phrase")
    )
    asked = pairs.distinct().orderBy(F.xxhash64("phrase")).limit(n)
    return settle(asked.select(F.xxhash64("phrase").alias("query_id"), "phrase"), "asked")


def main() -> None:
    spark = local_session(CPUS, name="tagseek-bench")
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        found = run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        return found

    spark.range(1000).selectExpr("sum(id)").collect()
    size = total_bytes(spark, f"{SF_DIR}/documents.parquet")
    index = timed("build_both_indexes", lambda: save_index(corpus(spark, SF_DIR), fresh_path(spark, "bench"), input_bytes=size))
    timed("build_dictionary", lambda: spelling.build_dictionary(index))
    one = query_table(spark, "phrase_exact").limit(1)
    mixed = query_table(spark, "exact")
    for name, asked in (("1", one), ("100", phrases(spark, 100))):
        timed(f"exact_search_{name}", lambda: exact_search(asked, index, STRICT).tags.collect())
        timed(f"exact_search_slop2_{name}", lambda: exact_search(asked, index).tags.collect())
        timed(f"phonetic_search_{name}", lambda: phonetic_search(asked, index, STRICT).tags.collect())
        timed(f"full_search_{name}", lambda: search(asked, index).tags.collect())
    many = phrases(spark, 10_000)
    timed("exact_search_10000", lambda: exact_search(many, index, STRICT).tags.collect())
    timed("phonetic_search_slop2_100", lambda: phonetic_search(asked, index).tags.collect())
    timed("exact_search_mixed", lambda: exact_search(mixed, index, STRICT).tags.collect())
    timed("wildcard_match", lambda: match.match_wildcard(query_table(spark, "wildcard_match"), index).count())
    timed("fuzzy_match", lambda: match.match_fuzzy(query_table(spark, "fuzzy_match"), index).count())
    timed("suggest_phrases", lambda: spelling.suggest_phrases(query_table(spark, "spelling"), index).collect())
    line = {
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
