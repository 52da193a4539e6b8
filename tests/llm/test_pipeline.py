import hashlib
import os

import pytest

from ..conftest import SF_SMALL

CONTRACT = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_decontaminate": "doc_id item_id",
    "op5_html": "page_id url text n_chars",
    "op6_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_neardup": "doc_id n_shingles component_id kept",
    "op8_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op9_quality": "doc_id kept",
    "op10_fingerprint": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited "
                        "near_next",
    "op11_language": "doc_id held_out lang_pred score",
    "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_divergence": "lang source part item value rank",
}


def test_contract_columns_are_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert set(names) == set(CONTRACT) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_runs_on_the_tables(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    assert set(CONTRACT[name].split()) <= set(df.columns)
    rows = df.count()
    table = "pages" if "page_id" in df.columns else "documents"
    if name not in ("op4_decontaminate", "op12_hard_negatives", "op13_divergence"):
        assert rows == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


def smallest_of_groups(texts, like):
    """Ids that are the smallest of their group: all pairs of 5-word sets, from ``like`` hundredths on."""
    from .test_neardup import shingles
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j]) if i < j else 0
            if both and 100 * both >= like * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i for i in sets if root(i) == i}


def test_stages_take_effect_and_keep_the_columns(spark):
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "pii", "bpe"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    columns, at = docs.columns, docs
    from envstats.llm import common, pii
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.written(stage(spark, at, SF_SMALL), name)
        assert out.columns == columns and out.schema == at.schema
        if name == "near_duplicates":
            want = smallest_of_groups({r.doc_id: r.text for r in at.collect()}, 80)
            assert {r.doc_id for r in out.select("doc_id").collect()} == want
        if name == "pii":
            for r in out.collect():
                assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
                assert r.text == texts[r.doc_id] or pii.base_spans(texts[r.doc_id])
        at = out
    last = corpus_pipeline.run(spark, SF_SMALL).collect()
    final = {r.doc_id: r.text for r in at.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in last} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in final.items()}
    assert 0 < len(last) < len(texts)


def test_stages_on_empty_documents(spark, tmp_path):
    import corpus_pipeline
    from envstats.llm.common import written
    at = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        at = written(stage(spark, at, SF_SMALL), name)
    assert at.count() == 0


def test_no_local_checkpoint_in_the_package():
    folder = os.path.dirname(__import__("envstats.llm", fromlist=["x"]).__file__)
    for f in os.listdir(folder):
        if f.endswith(".py"):
            assert "localCheckpoint" not in open(os.path.join(folder, f)).read()
