"""Write PLANS.md: formatted physical plans of the key lakeward operators.

Usage: python explain_plans.py [sf_dir]   (default /root/testdata/sf0.1)
Only plans are produced (``explain("formatted")``); queries with side effects
(landing, streaming) are represented by their batch building blocks.
"""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

NOTES = {
    "dedup_latest_lineitem": "Latest-wins dedup: partial WindowGroupLimit before the only "
                             "exchange (hash on the key), final limit after it.",
    "expect_warn": "Expectations: one scan per table pruned to the rule columns, partial "
                   "count_if aggregate, a single-partition final merge of one row per task.",
    "dq_consolidate": "Consolidation: watermark literal pushed into every log scan "
                      "(PushedFilters), explode, partial + final hash aggregate on 4 keys.",
    "dq_consolidate_join": "Relational watermark form: LEFT JOIN of a broadcast table "
                           "bounded by the number of pipelines.",
    "merge_upsert": "MERGE: left-anti join of history against source keys (AQE decides "
                    "broadcast from measured size) + union.",
    "decode_generation_xml": "Generation decode: one from_xml per document, periods exploded, "
                             "instant and resolution parsed once per period, then points "
                             "exploded; literal-map lookup. The exchange is the rebalance hint "
                             "that the query puts on its one-file table.",
    "incremental_silver": "Incremental silver: only keys touched by new rows are re-ranked.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from lakeward import queries as Q
    from lakeward.session import build_session
    spark = build_session("local[8]", app_name="lakeward-plans", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of key operators", "",
           f"Generated by `explain_plans.py` on `{sf_dir}` (local[8], AQE on; the plans "
           "show the initial AQE plan).", ""]
    for name, note in NOTES.items():
        df = Q.QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        out += [f"## {name}", "", note, "", "```", buf.getvalue().strip(), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
