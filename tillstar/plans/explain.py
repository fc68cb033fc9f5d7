"""Print final (after AQE) physical plans of registered queries and of the marts
served from a written star.

Usage: python -m tillstar.plans.explain <sf_dir> [key ...] [--marts q4_top_wilaya ...]
Keys should have small results (they are collected).
"""

from __future__ import annotations

import sys

WIDTH = 150


def final_plan(df) -> str:
    """Run the query and return its final adaptive plan tree (small results only:
    the rows are collected so that the frame's own plan is the one executed)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    return "\n".join(line[:WIDTH] for line in text.splitlines())


def main(argv: list[str]) -> None:
    from tillstar.operators import marts
    from tillstar.plans.pipeline import load_star
    from tillstar.plans.registry import queries
    from tillstar.session import fresh_path, get_session
    sf_dir = argv[0]
    rest = argv[1:]
    keys = rest[:rest.index("--marts")] if "--marts" in rest else rest
    mart_keys = rest[rest.index("--marts") + 1:] if "--marts" in rest else []
    spark = get_session()
    qs = queries()
    for k in keys:
        print(f"### {k} (from the input tables)\n\n```\n{final_plan(qs[k](spark, sf_dir))}\n```\n")
    if mart_keys:
        star = load_star(spark, sf_dir, fresh_path(spark, "explain-star"))
        for k in mart_keys:
            print(f"### {k} (on the written star)\n\n```\n{final_plan(getattr(marts, k)(star))}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
