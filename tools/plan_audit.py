"""Physical-plan audit of the build stages and every registered query.

usage: python tools/plan_audit.py <sf_dir> <label>   (prints a markdown table)

Counts, per plan (``explain("formatted")``, initial AQE plan): shuffle
exchanges, broadcast exchanges, sort-merge / broadcast-hash joins, windows,
hash / sort / object-hash aggregates, Python UDF nodes, parquet scans and the
widest scan schema. Run under different session settings through
STARLOOM_CONF (e.g. spark.sql.autoBroadcastJoinThreshold=-1).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.operators import fact as F_  # noqa: E402
from starloom.plans import views  # noqa: E402
from starloom.plans.catalog import QUERIES  # noqa: E402
from starloom.plans.warehouse import warehouse  # noqa: E402
from starloom.session import local_session  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def audit(text: str) -> dict[str, int]:
    tree = text.split("\n\n\n")[0]
    nodes = re.findall(r"[+:-]\s*([A-Za-z]+(?: [A-Za-z]+)*)\s+\(\d+\)", tree) + re.findall(
        r"^([A-Za-z]+(?: [A-Za-z]+)*)\s+\(\d+\)", tree, re.M
    )
    names = [n.strip() for n in nodes]

    def count(pred):
        return sum(1 for n in names if pred(n))

    widest = max((len(m.split(",")) for m in re.findall(r"ReadSchema: struct<(.*)>", text)), default=0)
    return {
        "shuffles": count(lambda n: n == "Exchange"),
        "broadcasts": count(lambda n: n == "BroadcastExchange"),
        "smj": count(lambda n: n.startswith("SortMergeJoin")),
        "bhj": count(lambda n: n.startswith("BroadcastHashJoin")),
        "window": count(lambda n: n in ("Window", "WindowGroupLimit")),
        "hash_agg": count(lambda n: n == "HashAggregate"),
        "sort_agg": count(lambda n: n == "SortAggregate"),
        "obj_agg": count(lambda n: n == "ObjectHashAggregate"),
        "python": count(lambda n: "Python" in n or "ArrowEval" in n),
        "scans": count(lambda n: n.startswith("Scan")),
        "widest_scan_cols": widest,
    }


def main() -> None:
    sf, label = sys.argv[1], sys.argv[2]
    spark = local_session(8)
    w = warehouse(spark, sf)
    stages = {
        "build: fact_order_item": F_.build_fact_order_item(
            w.sources["order_items"], w.sources["orders"], w.sources["payments"], w.dim_customer,
            w.dim_product, w.dim_seller, w.dim_geography, w.dim_date, w.dim_payment),
        "build: vw_sales": views.sales_view(
            w.fact_order_item, w.dim_date, w.dim_customer, w.dim_geography, w.dim_product, w.dim_seller,
            w.dim_payment),
        "build: vw_fulfillment": views.fulfillment_view(
            w.fact_order_item, w.sources["orders"], w.dim_date, w.dim_product, w.dim_seller, w.dim_customer),
    }
    qs = QUERIES
    cols = ["shuffles", "broadcasts", "smj", "bhj", "window", "hash_agg", "sort_agg", "obj_agg", "python",
            "scans", "widest_scan_cols"]
    print(f"### {label}\n")
    print("| plan | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    rows = list(stages.items()) + [(n, qs[n](spark, sf)) for n in qs]
    for name, df in rows:
        a = audit(plan(df))
        print(f"| {name} | " + " | ".join(str(a[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
