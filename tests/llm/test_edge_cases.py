"""Every operator and pipeline stage on odd rows and on an empty table."""

import numpy as np
import pytest

import corpus_pipeline
from quarry.llm import cap_filters, fingerprints, langid, lm, mixing, packing, quality, simhash, token_counts, toxicity
from quarry.llm.queries import tokenizer_path

OPERATORS = {
    "op1": lambda d, y, t: fingerprints.edited_fingerprints(d),
    "op2": lambda d, y, t: quality.score(d, quality.fit(d, y)),
    "op3": lambda d, y, t: mixing.mix(d),
    "op4": lambda d, y, t: lm.lm_scores(d, t),
    "op5": lambda d, y, t: toxicity.toxic_documents(d, y),
    "op6": lambda d, y, t: simhash.simhash_groups(d),
    "op7": lambda d, y, t: token_counts.token_counts(d, tokenizer_path("piece_bpe_32k.model")),
    "op9": lambda d, y, t: langid.identify(d, langid.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, odd, empty, labels, tokenizer):
    got = OPERATORS[name](odd, labels, tokenizer).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd.collect())
    by_id = {}
    for r in got:  # repeated rows have equal results, but for the copies that sampling gives them
        if name != "op3" and r["doc_id"] is not None:
            assert by_id.setdefault(r["doc_id"], r) == r
    assert OPERATORS[name](empty, labels.limit(0), tokenizer).collect() == []


def test_odd_values(odd, labels, tokenizer):
    lang = {r["doc_id"]: r for r in OPERATORS["op9"](odd, labels, tokenizer).collect()}
    assert [lang[i]["lang_pred"] for i in (0, 3, 4)] == ["und"] * 3 and lang[3]["score"] == 0
    assert lang[2]["lang_pred"] in ("en", "fr")
    lm_rows = {r["doc_id"]: r for r in OPERATORS["op4"](odd, labels, tokenizer).collect()}
    assert lm_rows[0]["n_tokens"] == lm_rows[3]["n_tokens"] == 1 and lm_rows[5]["n_tokens"] == 80_001
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in lm_rows.values())
    for name in ("op2", "op5"):
        assert all(0 <= r["score"] <= 1 for r in OPERATORS[name](odd, labels, tokenizer).collect())
        assert all(0 <= r["score"] <= 1 for r in OPERATORS[name](odd, labels.limit(0), tokenizer).collect())
    prints = {r["doc_id"]: r for r in OPERATORS["op6"](odd, labels, tokenizer).collect()}
    assert prints[0]["fingerprint"] == prints[3]["fingerprint"] == "0" * 16
    assert prints[3]["component_id"] == 0 and prints[50]["component_id"] == 2
    counts = {r["doc_id"]: r for r in OPERATORS["op7"](odd, labels, tokenizer).collect()}
    assert counts[3]["n_tokens"] == counts[0]["n_words"] == 0 and counts[5]["n_words"] == 80_000


def test_pack_odd(odd, empty, tokenizer):
    got = packing.pack(odd, tokenizer).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 0) == 1
    assert {r["piece"] for r in got if r["doc_id"] == 5} == set(range(len([r for r in got if r["doc_id"] == 5])))
    assert packing.pack(empty, tokenizer).collect() == []


def test_vectors_odd(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, None, 1), (4, [0.0, 0.0], 1),
            (5, [float("nan"), 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 0.0], None), (8, [], 1), (9, [1.0, 0.0, 0.0], 1),
            (None, [1.0, 0.01], 1)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS rid", "2 AS mult")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in cap_filters.near_vectors(v).collect()), key=str)
    assert got == sorted([(0, 3, 0, True), (1, 3, 0, False), (1, 3, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True),
                          (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True),
                          (None, 3, 0, False)], key=str)
    assert cap_filters.near_vectors(v.limit(0)).collect() == []


def test_vectors_of_any_label_and_size(spark):
    tiny, huge = [1e-50, 2e-50], [1e200, 2e200]
    near = [1.0, 0.2030672]  # cosine with the axis about 0.98, beyond single precision on one side
    below = [1.0, float(np.nextafter(np.sqrt(1 / 0.98 ** 2 - 1), 1) * (1 + 1e-12))]
    above = [1.0, float(np.sqrt(1 / 0.98 ** 2 - 1) * (1 - 1e-12))]
    rows = [(0, tiny, "a"), (1, tiny, "a"), (2, huge, "a"), (3, [1.0, 2.0], "b"), (4, [1.0, 0.0], "c"), (5, below, "c"),
            (6, [1.0, 0.0], "d"), (7, above, "d"), (8, near, "e"), (9, near, None)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cap_filters.near_vectors(v).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9)}
    wide = spark.createDataFrame([(i, [1.0, 0.0], 2 ** 40 + i // 2) for i in range(4)], "vec_id bigint, embedding array<float>, label bigint")
    assert sorted((r["vec_id"], r["component_id"]) for r in cap_filters.near_vectors(wide).collect()) == [(0, 0), (1, 0), (2, 2), (3, 2)]


def test_stages(spark, odd, empty, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (odd, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
            got = out.collect()
            docs = spark.createDataFrame(got, out.schema)
        assert bool(got) == (start is odd)


def test_stage_decisions(spark, odd):
    kept = simhash.keep_one_of_each(odd).collect()
    assert len(kept) == len({r["component_id"] for r in simhash.simhash_groups(odd).collect()})
    mixed = mixing.apply_mix(odd)
    assert mixed.count() == sum(r["copies"] for r in mixing.mix(odd).collect())
