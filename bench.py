"""Times the headline queries: one JSON line, seconds per query, warm second run."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from presswire import build_session  # noqa: E402
from presswire.plans import catalog  # noqa: E402

HEADLINE = (
    "word_count", "top_words", "doc_header", "dead_letters", "docs_xml", "tokens", "lemmas", "pos_tags",
    "entity_tags", "entity_spans", "entity_tags_joined", "chunks", "sentiment", "truecase", "regex_entities",
    "aliases", "relations", "documents_assembled", "documents_selected", "documents_tables", "clean_markup", "corpus_concat", "store_append",
    "store_upsert", "skip_existing", "stream_docs", "stream_word_count", "stream_window_count", "bulk_annotate",
)


def seconds(query, spark, sf_dir: str) -> float:  # noqa: ANN001
    began = time.monotonic()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.monotonic() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "presswire-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.build()
    times = {}
    for name in names:
        seconds(queries[name], spark, sf_dir)
        times[name] = round(seconds(queries[name], spark, sf_dir), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
