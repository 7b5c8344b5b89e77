"""Registered queries against their SQL counterparts.

Runs the first query of every operator; COHORTLENS_ALL=1 runs all of them.
"""

from __future__ import annotations

import os
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import compare, connect  # noqa: E402

from cohortlens.queries import load  # noqa: E402
from cohortlens.queries.registry import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
load()


def chosen() -> list[str]:
    if os.environ.get("COHORTLENS_ALL"):
        return list(ORACLES)
    seen, out = set(), []
    for name in ORACLES:
        op = re.match(r"[a-z]+\d*", name).group()
        if op not in seen:
            seen.add(op)
            out.append(name)
    return out


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", chosen())
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare(got, con.execute(ORACLES[name]).df()) == "ok"
