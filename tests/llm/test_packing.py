"""Packing: ids equal to the tokenizer's, best fit equal to the plain algorithm, sequences without gaps."""

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripflow.llm.packing import Encoder, best_fit, pack_documents, tokenise

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = Encoder(PATH)
ODD = ["<|endoftext|> a<|startoftext|>b C'S it'll ’ é İstanbul ΣΑΣ ½ ² 12 ª x y \x1c a\x0bb ＡＢ 𝒜 ''s 're'", "", " \n", "A" * 300 + " " + "é" * 200, "é ́x"]


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.one_of(st.text(st.characters(exclude_categories=['Cs']), max_size=40), st.lists(st.sampled_from(["The", "the,", "it's", " ", "\n", "'ll", "12", "###", "é", "ß", "<|", "\x1d"]), max_size=15).map("".join)))
def test_ids_equal_the_tokenizer(text):
    own = ENCODER
    want = own.tokenizer.encode(text, add_special_tokens=False).ids + [0]
    ids, lengths = own([b"", text.encode(), text.encode()])
    assert ids.tolist() == [0, *want, *want] and lengths.tolist() == [1, len(want), len(want)]


def test_a_small_memory_changes_nothing():
    small, rng = Encoder(PATH, remembered=40), random.Random(1)
    for k in range(30):
        texts = [" ".join(rng.choice(["The", "it's", "é" * rng.randint(1, 9), f"w{rng.randint(0, 99)}x,y"]) for _ in range(rng.randint(0, 30))) for _ in range(5)]
        ids, lengths = small([t.encode() for t in texts])
        want = [small.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]
        assert len(small.hashes) <= 40 and (np.diff(small.hashes.astype(object)) > 0).all()


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.integers(1, 60), st.data())
def test_best_fit_decreasing(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(1, 25), max_size=10))
    moves, opened = best_fit(counts, capacity)
    rooms: list[int] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [r for r in rooms if r >= length]
            rooms.remove(min(fit)) if fit else None
            rooms.append((min(fit) if fit else capacity) - length)
    assert opened == len(rooms)
    placed: dict[int, list] = {}
    ranks: dict[int, list] = {n: [] for n in counts}
    for length, lo, hi, sequence, offset in moves:
        ranks[length] += range(lo, hi)
        for k in range(lo, hi):
            placed.setdefault(sequence + k - lo, []).append((offset, length))
    assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
    for pieces in placed.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity


def test_documents_brute_force(spark):
    texts = [*ODD, None, "word " * 5000, "a", "a", "the end"]
    df = spark.createDataFrame([(i % 9 or None, t, 5, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, length int, piece int")
    packed = pack_documents(df, PATH, capacity=512, with_ids=True).toPandas()
    plain = Tokenizer.from_file(PATH)
    want = []
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(i % 9 or -1, k // 512, k, len(ids[k : k + 512]), zlib.crc32(np.array(ids[k : k + 512], "<u4").tobytes())) for k in range(0, len(ids), 512)]
    got = packed.fillna({"doc_id": -1})
    assert sorted(zip(got.doc_id.astype(int), got.piece, got.start, got.length, got.ids_crc32)) == sorted(want)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in packed.itertuples())
    for _, rows in packed.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert (rows.offset == rows.length.cumsum() - rows.length).all() and rows.length.sum() <= 512


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokenise(none, PATH).count() == 0 and pack_documents(none, PATH).count() == 0


def test_worker_keeps_one_encoder_and_drops_it_when_idle(spark, monkeypatch):
    import os
    import time

    import pandas as pd

    from tripflow.llm import packing

    def kept(_):
        from tripflow.llm import packing as own

        yield pd.DataFrame({"pid": [os.getpid()], "n": [len(own._encoders)]})

    df = spark.range(200).selectExpr("id AS doc_id", "concat('word ', id) AS text").repartition(8)
    assert packing.tokenise(df, PATH).count() == 200
    found = spark.range(8).repartition(8).mapInPandas(kept, "pid long, n long").collect()
    assert max(r.n for r in found) == 1

    monkeypatch.setattr(packing, "KEPT_S", 0.2)
    first = packing._taken(PATH)
    packing._given_back(PATH, first)
    again = packing._taken(PATH)
    assert again is first
    time.sleep(0.6)  # the timer of the earlier return leaves an encoder in use alone
    packing._given_back(PATH, again)
    assert packing._encoders
    time.sleep(0.6)
    assert not packing._encoders
