"""The stages against plain Python, and the registered queries against their SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import compare  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from test_near_dup import brute  # noqa: E402
from test_packing import check_places  # noqa: E402
from texts import SF  # noqa: E402

from tillcast import session  # noqa: E402
from tillcast.llm import decontaminate, pii, queries  # noqa: E402


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_on_the_table(spark, table):
    docs = table("documents")
    functions = dict(P.STAGES)
    assert list(functions) == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]

    clean = session.stage(functions["toxicity"](spark, docs, SF), "t")
    assert clean.schema == docs.schema
    toxic = {r["doc_id"] for r in table("labels").where("toxic = 1").collect()}
    kept = {r["doc_id"] for r in clean.collect()}
    assert len(toxic & kept) < 0.4 * len(toxic)
    fine = {r["doc_id"] for r in table("labels").where("toxic = 0").collect()}
    assert len(fine - kept) <= 0.02 * len(fine)

    single = session.stage(functions["near_dedup"](spark, clean, SF), "n")
    assert single.schema == docs.schema
    expected = brute([(r["doc_id"], r["text"]) for r in clean.collect()], P.SHINGLE)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(r[0] for r in expected if r[3])

    apart = session.stage(functions["decontamination"](spark, single, SF), "d")
    items = [decontaminate.normal(r["text"]) for r in table("benchmark").collect()]
    left = [r for r in single.collect() if not any(i in decontaminate.normal(r["text"]) for i in items)]
    assert rows(apart) == sorted(map(tuple, left), key=repr)

    masked = session.stage(functions["pii"](spark, apart, SF), "p")
    assert masked.columns == docs.columns
    for before, after in zip(sorted(left, key=lambda r: r["doc_id"]), sorted(masked.collect(), key=lambda r: r["doc_id"])):
        assert after["text"] == pii.mask(before["text"], pii.find(before["text"]))
        assert after["n_chars"] == len(after["text"]) and not pii.find(after["text"])

    packed = functions["packing"](spark, masked, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in left}
    check_places(packed, 4096)


def test_stages_on_edges(spark, edges, empty):
    for docs in (edges, empty):
        for _, function in P.STAGES[:-1]:
            out = session.stage(function(spark, docs, SF), "e")
            assert out.columns == docs.columns
            docs = out
        assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_agree_with_their_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLE[name]) == []


def test_every_operator_is_registered():
    names = list(queries.QUERIES)
    assert [n for n in names if n != "pipeline"] == sorted(
        (n for n in names if n != "pipeline"), key=lambda n: int(n[2:].split("_")[0])
    )
    assert {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14))
