"""Pieces: cutting, bounds, decoding of the ids returned, long words."""

import random

import numpy as np
import public_tokenizers


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_cutter_agrees_with_the_plain_cut_and_bounds():
    from skuflow.llm import pieces as P
    p = P.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    cutter, rng = P.Cutter(p.trie), random.Random(7)
    pairs, whole = {x[i:i + 2] for x, _, _ in p.rows for i in range(len(x) - 1)}, {x for x, _, _ in p.rows}
    for _ in range(300):
        texts = ["".join(rng.choice(["ab", "the", "ing ", "  ", "\n", "\t", ".", "é", "▁", "日", "\U0001f600", "ion", " "])
                         for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 5))]
        words, counts = cutter.words(texts)
        want = [[w for c in P.chunks_of(t) for w in P.cut_chunk(c, pairs)] for t in texts]
        assert words.to_pylist() == sum(want, []) and counts.tolist() == [len(ws) for ws in want]
        for w, reach in zip(words.to_pylist(), cutter.bounds(words.to_pylist())):
            assert reach == "".join(chr(96 + max([1] + [m for m in range(2, p.longest + 1) if i + m <= len(w) and w[i:i + m] in whole])) for i in range(len(w)))


def test_cutter_over_the_borders_of_slices(monkeypatch):
    from skuflow.llm import pieces as P
    cutter = P.Cutter(P.Pieces(public_tokenizers.path("piece_bpe_32k.model")).trie)
    texts = ["the thing, and  another\n one", "", "日本 the end"]
    want = [x if isinstance(x, list) else x.tolist() for x in (cutter.words(texts)[0].to_pylist(), cutter.words(texts)[1])]
    for n in (1, 2, 3, 7):
        monkeypatch.setattr(P, "SLICE", n)
        words, counts = cutter.words(texts)
        assert [words.to_pylist(), counts.tolist()] == want


def test_spelled_ids_decode_as_decode_ids():
    from skuflow.llm import pieces as P
    p, rng = P.Pieces(public_tokenizers.path("piece_bpe_32k.model")), random.Random(8)
    some = [*p.bytes][:256] + [i for x, _, i in p.rows if len(x) < 3]
    rows = [[rng.choice(some) for _ in range(rng.randint(0, 9))] for _ in range(500)] + [[p.byte_ids[b] for b in "▁x é".encode()], [0, 1, 2]]
    ends = np.cumsum([0, *map(len, rows)])
    for ids, spelt in zip(rows, P.spelled(np.array([i for r in rows for i in r], np.int32), ends, p.spelt)):
        want = P.decode_ids(ids, p.names, p.bytes)
        assert spelt.decode("utf-8", "replace") == want and P.same_text(spelt, P._digest(want.encode()))
        assert not P.same_text(spelt, P._digest((want + "x").encode()))


def test_round_trip_is_that_of_the_ids_returned(spark, monkeypatch):
    """With byte pieces that are mixed up, the texts written with them do not decode to themselves; the others do."""
    from skuflow.llm import pieces as P
    path, made = public_tokenizers.path("piece_bpe_32k.model"), P.Pieces.__init__

    def mixed_up(self, path):
        made(self, path)
        self.byte_ids = self.byte_ids[1:] + self.byte_ids[:1]
    docs = frame(spark, [(1, "plain words  here"), (2, "a \U0001f9ff b"), (3, ""), (4, None), (5, "\ufffd ▁ x")])
    assert all(r.round_trip for r in P.encode(docs, path).collect())
    monkeypatch.setattr(P.Pieces, "__init__", mixed_up)
    got = {r.doc_id: (r.round_trip, list(r.ids)) for r in P.encode(docs, path).collect()}
    p = P.Pieces(path)
    texts = {1: "plain words  here", 2: "a \U0001f9ff b", 3: "", 4: "", 5: "\ufffd   x"}
    for i, text in texts.items():
        assert got[i][0] == (P.decode_ids(got[i][1], p.names, p.bytes) == text)
    assert not got[2][0] and got[1][0]
