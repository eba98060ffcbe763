"""The pipeline against a plain version: each stage's decisions by loops over all documents."""

import hashlib

import sentencepiece

import corpus_pipeline
from icufeat.llm import languages, mixing, rules
from icufeat.llm.queries import tokenizer_file
from tests.llm.cases import no_documents, odd_documents
from tests.llm.test_mixing import brute_mix
from tests.llm.test_near_duplicates import brute
from tests.llm.test_text_models import brute_counts

DATA = "/root/testdata/sf0.01"


def stages(spark, docs, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], folder), name))
    return out


def rows_of(df):
    """Rows by id; ids are unique here."""
    return {r.doc_id: r for r in df.collect()}


def test_every_stage(spark):
    frames = stages(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA)
    given, named, good, single, drawn, encoded = map(rows_of, frames)
    assert all(f.columns == frames[0].columns for f in frames[:5])

    profiles = languages.learn_profiles(frames[0])
    found = {i: languages.closest(r.text, profiles) for i, r in given.items()}
    assert set(named) == {i for i, (name, s) in found.items() if name != "und" and s >= corpus_pipeline.LEAST_LANGUAGE_SCORE}

    model = rules.fit_classifier(frames[1], spark.read.parquet(f"{DATA}/labels.parquet"))
    keep = set()
    for i, r in named.items():
        n, *_, again = brute_counts(r.text)
        if n >= 10 and 100 * again <= 20 * n and model.probability(r.text, *rules.numbered(rules.words_of(r.text))) >= rules.KEEP_AT:
            keep.add(i)
    assert set(good) == keep

    firsts = brute([(i, r.text) for i, r in good.items()], corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert set(single) == set(firsts.values())

    cells = {r.doc_id: r for r in mixing.with_cells(frames[3]).collect()}
    cell = lambda r: (r["__source"], r["__lang"], r["__topic"])
    _, p, _, _ = brute_mix([(cell(r), r["__tokens"]) for r in cells.values()])
    assert set(drawn) == {i for i, r in cells.items() if r["__draw"] < p[cell(r)]}

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file())
    assert set(encoded) == set(drawn)
    for i, r in drawn.items():
        ids = library.encode(r.text)
        want = (len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))])
        assert (encoded[i].n_tokens, encoded[i].ids_sha256, encoded[i].decoded_sha256) == want


def test_odd_and_no_documents(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    odd = odd_documents(spark)
    frames = stages(spark, odd, str(tmp_path))
    assert all(f.columns == odd.columns for f in frames[:5])
    assert {r.doc_id for r in frames[1].collect()} == {None, 1, 2, 3, 7, 8, 9, 10, 11, 13, 14, 15}
    assert [f.count() for f in stages(spark, no_documents(spark), str(tmp_path))] == [0] * 6
