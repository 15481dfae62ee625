"""Write PLANS.md: join strategies and shuffle keys of the headline jobs, as planned at the test
scale and re-planned as if every table were too large for the planner to broadcast (only hints
backed by a bound remain).  Usage: python tools/plan_report.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import healthmart.operators.keys as K  # noqa: E402
from healthmart import queries as Q  # noqa: E402
from healthmart.session import build_session  # noqa: E402

JOBS = ["c1_target_patients", "c2_other_patients", "c3_patients_per_company", "c6_profit_per_company",
        "b1_fact_disease_outcome", "b2_fact_outcome_no_country", "s1j_fact_restated", "m9_dim_diseased_patient",
        "r1_medical_records_doctor", "r6_patient_own_record", "a10_enrich_outcomes_batch", "a2_load_outcome_table"]


JOIN_RE = re.compile(r"\(\d+\) (SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                     r"CartesianProduct)[^\n]*\nLeft keys \[\d+\]: \[([^\]]*)\]\nRight keys[^\n]*\nJoin type: (\w+)")
EXCHANGE_RE = re.compile(r"Arguments: (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)")


def _clean(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def explained(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def shape(build) -> tuple[list[str], list[str]]:
    """Joins and exchanges of what ``build()`` runs: the tables it writes on its way (numbered facts)
    and its result."""
    plans, freeze = [], K.freeze

    def spy(df, tag="frozen"):
        plans.append(explained(df))
        return freeze(df, tag)

    K.freeze = spy
    try:
        plans.append(explained(build()))
    finally:
        K.freeze = freeze
    p = "\n".join(plans)
    joins = [f"{kind} {how} on [{_clean(keys)}]" for kind, keys, how in JOIN_RE.findall(p)]
    return joins, [_clean(x) for x in EXCHANGE_RE.findall(p)]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", 4)
    out = ["# PLANS", "", "Generated by `tools/plan_report.py` from `explain(mode=\"formatted\")` at "
           f"`{sf_dir}`: the tables a job writes on its way (numbered facts) and its result.",
           "\"large\" re-plans with `spark.sql.autoBroadcastJoinThreshold` and the AQE threshold at -1: "
           "only broadcast hints backed by a bound remain (tables of fixed size, fixed domains with a checked size).", ""]
    for mode in ("test scale", "large"):
        if mode == "large":
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        out += [f"## {mode}", ""]
        for name in JOBS:
            spark.catalog.clearCache()
            joins, shuffles = shape(lambda: Q.REGISTRY[name].build(spark, sf_dir))
            out += [f"### {name}", "", "joins:", *[f"* {j}" for j in joins], "", "exchanges:",
                    *[f"* {s}" for s in shuffles], ""]
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
