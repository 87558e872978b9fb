"""Language identification: model arithmetic, held-out accuracy, rejection, edge cases."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import langid
from tripflow.llm.langid import ORDER, fit, held_out, predict, symbols

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def models(docs):
    return fit(docs.where(~held_out(F.col("doc_id"))))


def test_symbols():
    assert "".join(chr(int(c)) for c in symbols(" Ab, 12cÉ! ")) == "\0" * (ORDER - 1) + "ab\0cé\0"


def test_probabilities_sum_to_one(models):
    """After any context the known symbols take what the unknown-symbol share leaves."""
    code = symbols("the erin of and")
    alphabet = np.unique(np.concatenate([symbols("abcdefghijklmnopqrstuvwxyzäöüßéèêçñóíáúàùâîôûëï")[ORDER - 1 :], code]))
    for at in (ORDER - 1, ORDER + 3, len(code) - 1):
        total = np.zeros(len(models.languages))
        for c in alphabet:
            total += np.exp(models.probabilities(np.append(code[:at], c), np.array([at]))[0].astype(float))
        assert (total > 0.9).all() and (total < 1.02).all()


def test_held_out_accuracy(docs, models):
    found = predict(docs, models).where(held_out(F.col("doc_id"))).where("lang is not null").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98
    assert found.rejected.mean() < 0.02
    assert found.score.between(0, 1).all()


def test_noise_is_rejected_and_mixed_text_is_not(docs, models):
    rng = np.random.default_rng(5)
    noise = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 400))
    known = {r.lang: r.text for r in docs.where("length(text) between 800 and 3000").dropDuplicates(["lang"]).collect()}
    mixed = " ".join(t[:400] for t in known.values())
    _, _, rejected, _ = models.choose([noise, mixed, *known.values()])
    assert rejected.tolist() == [True, False] + [False] * len(known)


def test_edges(spark, models):
    rows = [(1, None), (2, ""), (3, " 12 !"), (4, "the and of " * 20_000), (5, "the and of"), (5, "the and of"), (None, "der die und")]
    df = spark.createDataFrame([(*r, None, None, "x", 0.5) for r in rows], "doc_id bigint, text string, lang string, source string, lang_pred string, score double")
    got = sorted((r.doc_id or 0, r.lang_pred, r.score == 0, r.rejected) for r in predict(df, models).collect())
    assert got == [(0, "de", False, False), (1, "und", True, True), (2, "und", True, True), (3, "und", True, True),
                   (4, "en", False, got[4][3]), (5, "en", False, False), (5, "en", False, False)]


def test_long_text_scores_like_its_parts(models, monkeypatch):
    text = "the erin of and that " * 3000
    whole, _, n = models.entropies([text])
    monkeypatch.setattr(langid, "STRETCH", 1000)
    parts, _, m = models.entropies([text])
    assert n[0] == m[0] and np.allclose(whole, parts)


def test_no_training_rows_and_empty_table(spark, docs, models):
    none = fit(docs.where("lang = 'xx'"))
    assert predict(docs.limit(3), none).where("lang_pred = 'und' and rejected").count() == 3
    assert predict(docs.where("1 = 0"), models).count() == 0


def test_sample_is_bounded(docs):
    sample = langid.bounded_sample(docs.select("doc_id", "text", "lang"), chars=80_000)
    sums = {r.lang: r.n for r in sample.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert sums and all(0 < n <= 20_000 for n in sums.values())


def test_default_sample_reads_half_a_million_code_points_a_language(spark):
    rows = spark.range(8000).selectExpr(
        "id as doc_id", "repeat(concat('word', id, ' '), 100) as text", "element_at(array('a', 'b', 'c', 'd'), int(id % 4) + 1) as lang")
    sums = langid.bounded_sample(rows).groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()
    assert len(sums) == 4 and all(350_000 < r.n <= 500_000 for r in sums)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_with_null_or_equal_ids_are_learned_from(spark, docs, doc_id):
    known = docs.where("lang in ('de', 'en') and length(text) > 200").select("text", "lang").limit(900)
    rows = known.select(F.lit(doc_id).cast("bigint").alias("doc_id"), "text", "lang").unionByName(
        spark.range(900).selectExpr(f"cast({doc_id or 'null'} as bigint) as doc_id", "'the hot row of and' as text", "'en' as lang"))
    sums = {r.lang: r.n for r in langid.bounded_sample(rows, chars=80_000).groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert sums.keys() == {"de", "en"} and all(20_000 < n <= 40_000 for n in sums.values())
    assert fit(rows, chars=80_000).languages == ["de", "en"]


def test_long_texts_and_many_labels_have_models(spark, docs):
    """Junk labels take nothing from the others, and a text over any bound counts in with its beginning."""
    known = docs.where("lang in ('de', 'en') and length(text) > 200").select("doc_id", "text", "lang").limit(300)
    junk = spark.range(300).selectExpr("id as doc_id", "concat('zq', id, repeat(' junkword', 400)) as text", "concat('junk', id) as lang")
    long = spark.range(2).selectExpr("id as doc_id", "repeat('quam olim abrahae ', 20000) as text", "'la' as lang")
    rows = known.unionByName(junk).unionByName(long)
    sums = {r.lang: r.n for r in langid.bounded_sample(rows, chars=200_000).groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert len(sums) == 303 and min(sums["de"], sums["en"]) > 90_000 and sum(sums.values()) <= 400_000
    alone = langid.bounded_sample(long, chars=50_000).agg(F.sum(F.length("text"))).first()[0]
    assert alone == 50_000


def test_sparse_model_is_the_dense_one():
    """Against interpolated Kneser-Ney written out with a table of all languages."""
    texts = {"a": ["abab ba", "abba"], "b": ["bcbc ab", "cab"]}
    batch = pa.RecordBatch.from_pydict({"lang": [k for k, v in texts.items() for _ in v], "text": [t for v in texts.values() for t in v]})
    counts = pd.concat([b.to_pandas() for b in langid._count_grams([batch])])
    models = langid.kneser_ney(counts)
    grams = [dict.fromkeys(zip(counts.lang, counts[f"g{k}"], counts[f"c{k}"], counts[f"g{k - 1}"] if k > 1 else counts.c1)) for k in range(1, ORDER + 1)]

    def count(lang, k, gram):
        own = counts[counts.lang == lang]
        return own[own[f"g{k}"] == gram].n.sum() if k == ORDER else own[own[f"g{k}"] == gram][f"g{k + 1}"].nunique()

    def probability(lang, code, k):
        if k == 0:
            return 1 / 1000
        end = np.array([len(code) - 1])
        gram, context = (int(h.view(np.int64)[0]) for h in (langid.hashes(code, end, k), langid.hashes(code, end - 1, k - 1)))
        own = [(g, count(lang, k, g)) for x, g, c, _ in grams[k - 1] if x == lang and c == context]
        every = [count(lang, k, g) for x, g, _, _ in grams[k - 1] if x == lang]
        once, twice = every.count(1), every.count(2)
        d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        total = sum(n for _, n in own)
        if not total:
            return probability(lang, code, k - 1)
        return max(dict(own).get(gram, 0) - d, 0) / total + d * len(own) / total * probability(lang, code, k - 1)

    code = symbols("abc bab cabba x")
    for at in range(ORDER - 1, len(code)):
        want = [np.log(probability(lang, code[: at + 1], ORDER)) for lang in ("a", "b")]
        assert np.allclose(models.probabilities(code, np.array([at]))[0], want, atol=1e-4)


@pytest.mark.parametrize("n", [1, 4, 40])
def test_few_long_documents_calibrate_the_rejection(spark, docs, n):
    """Sampled text of a few documents: noise is rejected, and more of the same text is not."""
    texts = [r.text for r in docs.where("lang = 'en' and length(text) > 1000").orderBy("doc_id").limit(300).collect()]
    rows = [(i, " ".join(texts[i : 240 : n]), "en") for i in range(n)]
    models = fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    rng = np.random.default_rng(5)
    noise = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 400))
    _, _, rejected, _ = models.choose([noise, *texts[240:]])
    assert np.isfinite(models.limit) and rejected[0] and rejected[1:].mean() < 0.1
