"""The pipeline's stages on a small corpus with planted cases."""

import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from termlift.llm.queries import TOKENIZER
from termlift.plans.scale import scratch_paths, written
from termlift.sources.tables import rows
from tests.llm.conftest import words
from tests.llm.test_dedup import brute_removal, plain_set
from tests.llm.test_tokens import check_packing, packed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus():
    passage = " ".join(words(70, 900))
    texts = [" ".join(words(120 + i % 40, i)) for i in range(60)]
    near = texts[3].split()
    near[50] = "changed"
    planted = [texts[2], " ".join(near), texts[4] + " " + passage, passage + " " + texts[5], "too short", None, " ".join(w + "###" for w in words(100, 77))]
    return [(i, text, "en", "web", None) for i, text in enumerate(texts + planted)]


def test_stages_do_their_part(spark, corpus, tmp_path):
    docs = rows(spark, corpus, SCHEMA)
    good, single, cut, sequences = (None,) * 4
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), name)
        results.append(docs)
    good, single, cut, sequences = results
    ids = [{row.doc_id for row in result.collect()} for result in results]
    assert ids[0] == {*range(64)}
    texts = {i: text for i, text, *_ in corpus}
    sets = {i: plain_set(texts[i], 5) for i in ids[0]}
    dropped = {j for j in ids[0] for i in ids[0] if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert {60, 61} <= dropped and ids[1] == ids[0] - dropped
    order = sorted(ids[1])
    for result in results[:3]:
        assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    removal = dict(zip(order, brute_removal([texts[i] for i in order], 50)))
    left = {row.doc_id: row for row in cut.collect()}
    assert {i: len(left[i].text.encode()) for i in order} == {i: size - gone for i, (size, gone, *_) in removal.items()}
    assert all(row.n_chars == len(row.text) for row in left.values())
    library = Tokenizer.from_file(TOKENIZER)
    check_packing(sequences.collect(), {i: library.encode(left[i].text, add_special_tokens=False).ids for i in order}, 2048)
    assert zlib.crc32(packed([1])) == sequences.filter(F.col("doc_tokens") == 1).first().ids_crc32 if any(not left[i].text for i in order) else True


def test_whole_run_equals_its_stages(spark, corpus, tmp_path):
    """The rows of a run are those of the stages, each written by hand, and only the last result is left in the scratch folder."""
    rows(spark, corpus, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    order = ["doc_id", "start"]
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    before = set(scratch_paths())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert len(set(scratch_paths()) - before) == 1
    got, expected = (one.select(*columns).orderBy(*order).collect() for one in (whole, docs))
    assert got == expected and len({row.doc_id for row in got}) > 50


def test_empty_repeated_and_clashing_rows(spark, corpus, tmp_path):
    schema = SCHEMA + ", q_n_words string, component_id long, kept boolean, block long"
    extra = [(*row, "x", 5, False, 7) for row in [*corpus[:8], corpus[0], (None, corpus[9][1], "en", "web", None)]]
    for name, values in (("none", []), ("some", extra)):
        folder = tmp_path / name
        docs = rows(spark, values, schema)
        for place, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(folder)).write.parquet(str(folder / stage_name))
            docs = spark.read.parquet(str(folder / stage_name))
            if place < 3:
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "q_n_words", "component_id", "kept", "block"]
            if place in (1, 2) and values:
                ids = [row.doc_id for row in docs.collect()]
                assert len(ids) == len(set(ids)) and set(ids) == {*range(8), None}
        assert docs.count() == 0 if not values else docs.count() > 8
