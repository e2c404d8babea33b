"""The corpus pipeline's stages on a small corpus, against what each must keep and drop."""

import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from lociframe.llm import bpe, near_dedup  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    words = {"en": [f"the{i}ing" for i in range(300)], "fr": [f"le{i}eux" for i in range(300)]}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    item = prose("en", 30)
    rows = [[i, prose(("en", "fr")[i % 2], 80), ("en", "fr")[i % 2]] for i in range(60)]
    rows[10][1] = rows[4][1]  # an exact copy
    near = rows[6][1].split()
    near[40] = "changed"
    rows[12][1] = " ".join(near)  # a near copy
    rows[20][1] += "\n" + item  # a leak
    rows[21][1] += "\nshared line of several words here"
    rows[23][1] += "\nshared line of several words here"
    rows += [[100, None, "en"], [101, "", "fr"], [102, "12 34 !!", None], [None, prose("en", 50), None], [30, rows[30][1], "en"]]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = [(a, b, c, "s", len(b or "")) for a, b, c in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, corpus)
        path = f"{corpus}/stage{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert sorted(docs.columns) == sorted(COLUMNS), name
        seen[name] = docs.collect()
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert not {100, 101, 102} & set(ids["language ID"]) and len(ids["language ID"]) == 62
    lines = {r.doc_id: r for r in seen["line dedup"]}
    assert lines[10].text == "" and lines[21].text.endswith("words here") and "shared" not in lines[23].text
    assert all(r.n_chars == len(r.text) for r in lines.values()) and len(ids["line dedup"]) == 62
    # texts that the line stage emptied have no shingles and are nobody's copy; a repeated id stays once
    assert 30 in ids["MinHash near-dedup"] and ids["MinHash near-dedup"].count(30) == 1 and None in ids["MinHash near-dedup"]
    assert 20 not in ids["benchmark decontamination"] and set(ids["MinHash near-dedup"]) - set(ids["benchmark decontamination"]) == {20}
    vocabulary = bpe.Vocabulary(bpe.read_vocabulary(pipeline.VOCABULARY))
    text = {r.doc_id: r.text for r in seen["benchmark decontamination"]}
    assert all(vocabulary.decode(r.ids) == text[r.doc_id] and 4 * r.n_tokens == len(r.ids) for r in seen["BPE encoding and decoding"])


def test_near_copies_on_their_own(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    out = {r.doc_id for r in pipeline.dedup_documents(spark, docs, corpus).collect()}
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found[10] == 4 and found[12] == 6 and not {10, 12} & out and {4, 6, 100, 101, None} <= out


def test_empty_corpus(spark, corpus, tmp_path):
    none = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, corpus).count() == 0
