"""Training-data operators on small fixtures, against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ", k long, size long, label string, runs string, `__text` string, gid long, `__id` long, severity double"


def frame(spark, texts, source="s", extra=False):
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in texts]
    if extra:
        rows = [(*r, 1, 2, "x", "y", "z", 3, 4, 5.0) for r in rows]
    return spark.createDataFrame(rows, DOC + (CLASH if extra else ""))


def odd_texts():
    rng = random.Random(4)
    words = [rng.choice(["al", "be", "ga", "de"]) + rng.choice(["ra", "lo", "mi"]) + str(rng.randint(0, 30)) for _ in range(400)]
    long = " ".join(rng.choice(words) for _ in range(4000))
    return [(0, "one two three four five six seven"), (1, None), (2, ""), (3, " \t\n"), (4, long), (5, long), (6, long + " tail"),
            (7, "x" * 5000), (8, "naïve café 日本語\u2028 \U0001f600 z"), (8, "same id, other text"), (0, "one two three four five six seven"),
            (None, "no id here at all"), (9, "a"), (10, "one two three four five six seven eight")]


# -- 1 toxicity --------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    from skuflow.llm.toxicity import score_documents
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) == 0
    scored = score_documents(docs.select("doc_id", "text"), labels.where(~held)).select("doc_id", "__tox.*")
    got = scored.join(labels.where(held), "doc_id").toPandas()
    assert ((got.rejected == (got.toxic == 1)).mean()) > 0.97
    assert got[got.toxic == 1].severity.mean() > got[got.toxic == 0].severity.mean() + 0.5
    assert scored.count() == docs.count()


def test_toxicity_edges(spark):
    from skuflow.llm.toxicity import Ordinal, score_documents
    docs = frame(spark, odd_texts(), extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = score_documents(docs, none).select("doc_id", "__tox.*").collect()
    assert len(rows) == len(odd_texts()) and not any(r.rejected for r in rows)
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (4, 1, 0), (9, None, None), (None, 1, 1), (10, 1, 1)], "doc_id long, quality int, toxic int")
    rows = score_documents(docs, labels).select("doc_id", "__tox.*").collect()
    assert len(rows) == len(odd_texts()) and all(0 <= r.severity <= 3 for r in rows)
    # thresholds stay ordered and probabilities fall with the grade
    rng = np.random.default_rng(0)
    y, x = rng.integers(0, 4, 200), None
    x = y + rng.normal(0, 0.5, 200)
    m = Ordinal.fit(np.arange(200), np.zeros(200, int), x, y, 1, 3)
    assert (np.diff(m.cuts) > 0).all() and m.weights[0] > 1
    p = m.at_least(np.array([0.3, 2.0]))
    assert (np.diff(p, axis=1) <= 0).all()


# -- 2 repeats ---------------------------------------------------------------------------------------------------


def brute_repeats(rows, length):
    """rows: (order key, bytes)."""
    first, out = set(), []
    for _, raw in sorted(rows, key=lambda r: (r[0], hashlib.sha256(r[1]).digest()[:7])):
        cover = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in first:
                cover[p:p + length] = True
            first.add(w)
        runs = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~cover].tobytes()
        out.append((len(raw), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeats_brute_force(spark, hot):
    from skuflow.llm.repeats import repeated_spans
    rng = random.Random(hot)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randint(5, 60))) for _ in range(8)]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    texts += odd_texts() + [(50, "ab" * 300), (51, "ab" * 200), (52, texts[3][1])]
    got = repeated_spans(frame(spark, texts, extra=True), length=20, hot=hot, block_bytes=500, with_kept=True).collect()
    key = lambda i: (1 << 63) - 1 if i is None else i
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(
        [(key(i), (t or "").encode()) for i, t in texts], 20)
    for r in got:
        assert sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed and len(r.spans) == 2 * r.n_spans
        assert r.kept is None or hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_bounded_expansion_matches_counting():
    from skuflow.llm.repeats import repeated_rows
    rng = random.Random(1)
    for _ in range(60):
        length, letters = rng.choice([3, 4, 6, 10]), rng.choice(["ab", "abc", "a", "abcdefgh"])
        segments = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))).encode() for _ in range(rng.randint(1, 8))]
        group, seg, off = repeated_rows(segments, length)
        got, want = {}, {}
        for g, s, o in zip(group.tolist(), seg.tolist(), off.tolist()):
            got.setdefault(g, []).append((s, o))
        for s, x in enumerate(segments):
            for p in range(len(x) - length + 1):
                want.setdefault(x[p:p + length], []).append((s, p))
        assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)


def test_repeats_empty(spark):
    from skuflow.llm.repeats import repeated_spans
    assert repeated_spans(frame(spark, [])).count() == 0


# -- 3 pieces ----------------------------------------------------------------------------------------------------


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_pieces(text, p):
    """Best path over the whole normalised text, ties to the longer last piece."""
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    table = {piece: (score, i) for piece, score, i in p.rows}
    best = [(0.0, 0, None)] + [None] * len(s)
    for end in range(1, len(s) + 1):
        for n in range(min(p.longest, end), 0, -1):
            piece = s[end - n:end]
            score, ids = (table[piece][0], [table[piece][1]]) if piece in table else (p.unknown, [p.byte_ids[b] for b in piece.encode()])
            if (piece in table or n == 1) and (best[end] is None or best[end - n][0] + score > best[end][0]):
                best[end] = (best[end - n][0] + score, n, ids)
    out, at = [], len(s)
    while at:
        out.append(best[at][2])
        at -= best[at][1]
    return [i for ids in reversed(out) for i in ids]


def test_pieces_brute_force_and_round_trip(spark):
    from skuflow.llm.pieces import Pieces, decode, encode
    p = Pieces(MODEL)
    texts = odd_texts() + [(20, "  two  spaces \n\n lines\n"), (21, "===========================  ....."), (22, "a" * 700), (23, "▁x ▁ y"), (24, "the the\tthe"),
                           (25, "ab" * 90 + "日本" * 70), (26, " ")]
    coded = encode(frame(spark, texts, extra=True), MODEL)
    got = coded.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in got) == sorted((i is None, i or 0, brute_pieces(t or "", p)) for i, t in texts)
    assert all(r.round_trip for r in got) and all(r.n_pieces == len(r.ids) for r in got)
    back = decode(coded, MODEL).collect()
    assert sorted(r.text for r in back) == sorted((t or "").replace("▁", " ") for _, t in texts)
    assert encode(frame(spark, []), MODEL).count() == 0


def test_pieces_equal_the_librarys_unigram_search(spark):
    """The library, told that the model is a unigram one, on words where its single precision is exact."""
    import sentencepiece

    from skuflow.llm.pieces import Pieces, encode
    raw = open(MODEL, "rb").read()
    unigram = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(b"\x06tok_v0\x18\x02", b"\x06tok_v0\x18\x01"))
    rng = random.Random(2)
    words = ["".join(rng.choice(["th", "er", "ing", "tion", "qu", "a", "o", "ß", "é"]) for _ in range(rng.randint(1, 6))) for _ in range(300)]
    scores = dict((i, s) for _, s, i in Pieces(MODEL).rows)
    got = {r.doc_id: list(r.ids) for r in encode(frame(spark, list(enumerate(words))), MODEL).collect()}
    exact = [i for i in got if all(scores[x] > -1e8 for x in got[i])]
    assert len(exact) > 200
    for i in exact:
        assert got[i] == unigram.nbest_encode(words[i], nbest_size=2)[0], words[i]


# -- 4 fingerprints ----------------------------------------------------------------------------------------------


def test_fingerprints(spark):
    from skuflow.llm.fingerprints import fingerprint_documents
    texts = odd_texts()
    got = fingerprint_documents(frame(spark, texts, extra=True)).collect()
    order = sorted(((t or "") for _, t in texts), key=lambda t: 0)
    order = [t for _, t in sorted(((-1 if i is None else i, t or "") for i, t in texts))]
    want = []
    for a, b in zip(order, order[1:] + order[:1]):
        cut = len(a) // 4
        e = a[:len(a) - cut] + b[:cut]
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        want.append((len(a), hashlib.sha256(e.encode()).hexdigest(), common))
    assert sorted((r.n_chars, r.edited_sha256, r.common_next) for r in got) == sorted(want)
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(r.n_chars)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.common_edited >= r.n_chars - r.n_chars // 4
    long = [r for r in got if r.n_chars > 10_000]
    assert all(0.4 < r.near_edited for r in long)
    assert fingerprint_documents(frame(spark, [])).count() == 0
    one = fingerprint_documents(frame(spark, [(3, "abcdefgh")])).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].common_next == 8


def test_span_equality_and_extension():
    from skuflow.llm.fingerprints import Printer, common_extension
    rng, printer = random.Random(3), Printer()
    a = "".join(rng.choice("ab") for _ in range(300))
    b = a[40:200] + "x" + a
    x, y = printer.hashes(a), printer.hashes(b)
    for _ in range(200):
        i, j = rng.randrange(300), rng.randrange(len(b))
        want = next((k for k in range(min(300 - i, len(b) - j)) if a[i + k] != b[j + k]), min(300 - i, len(b) - j))
        assert common_extension(x, i, y, j) == want
        n = rng.randint(1, 20)
        if i + n <= 300 and j + n <= len(b):
            assert (x.span_hash(i, i + n) == y.span_hash(j, j + n)) == (a[i:i + n] == b[j:j + n])


# -- 5 personal data ---------------------------------------------------------------------------------------------


def brute_pii(text):
    import re

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub(r"\D", "", s, flags=re.A)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]
    out = []
    for rank, (kind, pattern, good) in enumerate(kinds):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if good(m.group())]
    return ",".join(x[2] for x in sorted(out))


def test_pii_brute_force(spark):
    from skuflow.llm.pii import find_pii
    rng = random.Random(5)
    bits = ["a.b@c.de", "x@y", "@", ".", "1.2.3.4", "256.1.1.1", "01.002.3.04", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "  ", " ", "-", "+1 (262) 555-3752",
            "+", "12", "é", "日", "\U0001f600", "\n", "w", "_", "5500005555555559", "a@b.c@d.e", "..", "q@w..e", "q@w.e.", "+49 30", "DE89 3704 0044 0532 0130 00"]
    texts = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(400)]
    texts += odd_texts() + [(500, "1 " * 30_000), (501, "a." * 30_000 + "@b" + ".c" * 30_000), (502, "9" * 50_000), (503, "+1" + " " * 50_000)]
    got = find_pii(frame(spark, texts, extra=True)).collect()
    want = sorted(hashlib.sha256(brute_pii(t or "").encode()).hexdigest() for _, t in texts)
    assert sorted(r.base_sha256 for r in got) == want
    for r in got:
        assert [s.start for s in r.found] == sorted(s.start for s in r.found)


def test_pii_added_spans_scores_and_redaction(spark):
    from skuflow.llm.pii import find_pii, redact
    docs = frame(spark, [(1, "IBAN DE89 3704 0044 0532 0130 00, mail: é a.b@c.de"), (2, "GB82WEST12345698765432 and GB82WEST12345698765433"),
                         (3, "version 1.2.3.4"), (4, "server 1.2.3.4"), (5, None), (6, "")], extra=True)
    got = {r.doc_id: r for r in find_pii(docs).collect()}
    assert "iban:5:32" in got[1].spans and got[1].n_email == 1 and got[2].n_iban == 1
    assert got[3].found[0].score < got[4].found[0].score
    masked = {r.doc_id: r for r in redact(docs, 0.5).collect()}
    assert masked[1].text.endswith("mail: é <EMAIL>") and "3704" not in masked[1].text and masked[1].n_chars == len(masked[1].text)
    assert masked[3].text == "version 1.2.3.4" and masked[4].text == "server <IP>" and masked[5].text is None
    assert redact(docs).columns == docs.columns


def test_confirmed_spans_are_masked_whatever_stands_near(spark):
    import corpus_pipeline as C
    from skuflow.llm.pii import find_pii
    texts = [(1, "Maria said +49 30 1234 5678"), (2, "order 12, +1 (262) 555-3752"), (3, "version page of 10.0.0.7"),
             (4, "in order to reach serial id +49 30 1234 5678"), (5, "order serial 4111 1111 1111 1111"), (6, "release, chapter, section 1.2.3.4"),
             (7, "paid in Madrid +49 30 1234 5678"), (8, "the border, an intersection of 10.0.0.7"), (9, "version 256.1.1.1")]
    docs = frame(spark, texts, extra=True)
    want = {1: "Maria said <PHONE>", 2: "order 12, <PHONE>", 3: "version page of <IP>", 4: "in order to reach serial id <PHONE>",
            5: "order serial <CARD>", 6: "release, chapter, section <IP>", 7: "paid in Madrid <PHONE>",
            8: "the border, an intersection of <IP>", 9: "version 256.1.1.1"}
    masked = C.personal_data(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in masked} == want and all(r.n_chars == len(r.text) for r in masked)
    score = {r.doc_id: r.found[0].score for r in find_pii(docs).collect() if r.found}
    assert score[1] == score[7] == score[8] == 0.6 and score[2] == score[4] == score[6] == 0.3


# -- 6 near-duplicates -------------------------------------------------------------------------------------------


def brute_near(rows, words, percent):
    import re
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        n = min(words, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_brute_force(spark, words, percent):
    from skuflow.llm.near_dup import near_duplicates
    rng = random.Random(words)
    vocab = [f"w{i}" for i in range(60)]
    texts = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 9)):  # chains of edits: links that a bucket's first member does not show
            base = list(base)
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
            texts.append((len(texts), " ".join(base) if rng.random() < 0.9 else "\t".join(base).upper()))
    texts += [(200 + i, t) for i, (_, t) in enumerate(odd_texts()) if i not in (10,)]
    got = near_duplicates(frame(spark, texts, extra=True), words, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(texts, words, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_nulls_and_empty(spark):
    from skuflow.llm.near_dup import near_duplicates
    got = near_duplicates(frame(spark, [(None, "a b c d"), (1, "a b c d"), (2, None), (2, None)])).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got)) == [
        (False, 1, 2, 1, True), (False, 2, 0, 2, True), (False, 2, 0, 2, True), (True, 0, 2, 1, False)]
    assert near_duplicates(frame(spark, [])).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark):
    from skuflow.llm.near_dup import near_duplicates
    rng = random.Random(12)

    def edited(base, n):
        out = list(base)
        for at in rng.sample(range(10, 110), n):
            out[at] = f"e{rng.random()}"
        return " ".join(out)
    rows = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(120)]
        # unlike each other, and first in every bucket that the two documents below share: only the last pass judges those
        rows += [(1000 * g + i, edited(base, 4)) for i in range(40)]
        for doc_id in (1000 * g + 500, 1000 * g + 501):
            rows += [(doc_id, edited(base, 1))] + [(doc_id, " ".join(f"u{rng.random()}" for _ in range(30))) for _ in range(3)]
    want = brute_near(rows, 3, 85)
    assert {c for k, _, c in want if k % 1000 >= 500} == {500, 1500, 2500, 3500}
    for own in (rows, rows[::-1]):
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, own), 3, 85).collect()) == want


def test_odd_sketch_counts_differences():
    from skuflow.llm.near_dup import odd_sketch, xor_bound
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 116, dtype=np.uint64)
    b = a.copy()
    b[:17] = rng.integers(0, 1 << 62, 17, dtype=np.uint64)
    bits = int(np.bitwise_count(odd_sketch(a) ^ odd_sketch(b)).sum())
    assert 20 <= bits <= 34 and bits <= xor_bound(85, 116)
    c = rng.integers(0, 1 << 62, 116, dtype=np.uint64)
    assert int(np.bitwise_count(odd_sketch(a) ^ odd_sketch(c)).sum()) > xor_bound(85, 116)


# -- 7 urls ------------------------------------------------------------------------------------------------------


URLS = [None, "", "no scheme", "http://EXAMPLE.com/en/x?q#f", "https://www.example.com/en/", "https://a.www.example.com/en/1", "http://com", "http://com/", "x://y.net/es/1", "http://net/es",
        "http://net/fr/", "http://notexample.com/en/a", "http://b.org/p?utm_source=a&b=2&a=1", "https://www.b.org:443/p/?a=1&b=2&ref=z", "http://b.org/p?a=1&b=2#top", "http://c.org", "://h/p", "http://com?x", "http://d.org/#://e"]


@pytest.mark.parametrize("broadcast_blocks", [1 << 15, 0])
def test_urls(spark, broadcast_blocks):
    from skuflow.llm.url_filter import RULES, filter_urls, refetched
    pages = spark.createDataFrame([(i, u, "h", 1, "k") for i, u in enumerate(URLS + URLS[3:5])], "page_id long, url string, html string, rule long, key string")
    rules = spark.createDataFrame(list(RULES), "host string, path string, action string")
    got = {r.page_id: r for r in filter_urls(pages, rules, refetched(pages), broadcast_blocks).collect()}
    assert len(got) == len(URLS) + 2
    for i, r in got.items():
        u = (URLS + URLS[3:5])[i] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        cut = next((j for j, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(h + p, a) for h, p, a in RULES if (host == h or host.endswith("." + h)) and path.startswith(p) and "://" in u]
        best = max(fits, key=lambda f: len(f[0]), default=(None, None))
        assert (r.host, r.path, r.rule) == (host, path, best[0]), u
        assert r.verdict == (best[1] or ("block" if r.listed else "allow"))
    assert got[12].listed and got[13].listed and got[14].listed and not got[15].listed
    assert filter_urls(pages.limit(0), rules, refetched(pages), broadcast_blocks).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    from skuflow.llm.url_filter import bloom_hits, blocked_bloom
    keys = spark.range(20_000).select(F.concat(F.lit("in"), "id").alias("key"))
    bloom, blocks = blocked_bloom(keys, 20_000)
    assert bloom_hits(keys, bloom, blocks).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("out"), "id").alias("key"))
    assert bloom_hits(others, bloom, blocks).count() < 400


# -- 8 neighbours ------------------------------------------------------------------------------------------------


def test_neighbours_recall(spark):
    from skuflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    got = QUERIES["op8_nearest"](spark, d).toPandas()
    e = pd.read_parquet(f"{d}/embeddings.parquet")
    x, ids = np.array(e.embedding.to_list(), dtype=float), e.vec_id.to_numpy()
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        mine = got[got.query_id == ids[i]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine.score, x[mine.vec_id] @ x[i], atol=1e-12)
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(mine.vec_id))
        total += 20
    assert hit / total >= 0.9


def test_neighbours_edges(spark):
    from skuflow.llm.ann import nearest
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (None, [1.0, 1.0])]
    rows += [(20 + i, [1.0, 0.0]) for i in range(60)] + [(100, [0.5, -0.0]), (101, [0.5, 0.0]), (102, [-1.0, 0.0]), (20, [1.0, 0.0])]
    v = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, score double, rank int")
    got = nearest(v, F.col("vec_id") % 20 == 0, k=20, fraction=1.0).toPandas()
    first = got[got.query_id == 0].sort_values("rank")
    assert list(first.vec_id)[:5] == [20, 20, 21, 22, 23] and set(first.score) == {1.0}
    twenty = got[got.query_id == 20]
    assert 20 not in set(twenty.vec_id) and set(got.query_id) == {0, 20, 40, 60, 100}
    few = nearest(v.where("vec_id in (0, 100, 102)"), F.col("vec_id") == 0, k=20, fraction=1.0).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 100, 0.5), (2, 102, -1.0)]
    assert nearest(v.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_blocks_are_bounded_for_strided_ids(spark, monkeypatch):
    from skuflow.llm import ann
    rng = np.random.default_rng(13)
    v = spark.createDataFrame([(20 * i, x.tolist()) for i, x in enumerate(rng.normal(size=(640, 6)))], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, ann.nearest(v, F.lit(True), k=5, trees=1, depth=2, fraction=1.0).collect()))
    rank = ann._rank

    def guarded(k):
        own = rank(k)

        def run(queries, members):
            assert len(queries) <= 2 * 32 and len(members) <= 2 * 32, (len(queries), len(members))
            return own(queries, members)
        return run
    monkeypatch.setattr(ann, "_QUERIES", 32)  # 20 blocks
    monkeypatch.setattr(ann, "_MEMBERS", 32)  # 5 chunks of a leaf
    monkeypatch.setattr(ann, "_rank", guarded)
    assert sorted(map(tuple, ann.nearest(v, F.lit(True), k=5, trees=1, depth=2, fraction=1.0).collect())) == want


# -- 9 records ---------------------------------------------------------------------------------------------------


WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_records(spark, tmp_path):
    from tokenizers import Tokenizer

    from skuflow.llm.records import read_shuffled, write_index, write_records
    texts = odd_texts() + [(30, "It's don't ΣΑΣ, e\u0301a <|endoftext|> a,b ...!? x². ǅ \x1cz \u2028q")]
    write_records(frame(spark, texts, extra=True), f"{tmp_path}/r", WORDS)
    index = write_index(spark, f"{tmp_path}/r", f"{tmp_path}/i")
    got = index.orderBy("start").collect()
    tok, start = Tokenizer.from_file(WORDS), 0
    order = sorted(((-1 if i is None else i, t or "") for i, t in texts))
    for r, (i, t) in zip(got, order, strict=True):
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens) == (None if i < 0 else i, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    parts = [read_shuffled(spark, f"{tmp_path}/r", index, 7, p, 3).collect() for p in range(3)]
    assert sorted(len(r.ids) for p in parts for r in p) == sorted(r.n_tokens for r in got)


def test_damaged_record_is_found():
    from skuflow.llm.records import frame as record, frames
    good = record(5, np.arange(4, dtype="<u2").tobytes(), 2) + b"\n"
    assert [(d, i.tolist()) for _, _, d, i in frames(good * 2)] == [(5, [0, 1, 2, 3])] * 2
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            list(frames(bytes(bad)))


# -- 10 mixing ---------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > cap * sizes[s]]
        if not over:
            out |= {s: left * w[s] / total for s in free}
            break
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
        left -= sum(out[s] for s in over)
    return out


def test_targets_by_brute_force(spark):
    from skuflow.llm.mixing import source_targets
    rng = random.Random(6)
    for trial in range(4):
        sizes = {s: rng.choice([0, 1, 10, 500, 10_000]) for s in ["b", "a", "é", "Z", "zz", "", None][:rng.randint(1, 7)]}
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in sizes), (sizes, got, want)


def test_highest_quotients():
    from skuflow.llm.mixing import highest_quotients
    votes, most = np.array([53_000.0, 24_000, 23_000]), np.array([99, 99, 99])
    assert highest_quotients(votes, most, 7).tolist() == [3, 2, 2]  # the usual worked example
    assert highest_quotients(votes, np.array([2, 99, 99]), 7).sum() == 7
    assert highest_quotients(votes, np.array([1, 1, 0]), 7).tolist() == [1, 1, 0]


def test_mixing(spark):
    from skuflow.llm.mixing import mix_sources
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 300)), rng.choice(["a", "b", "c", None])) for i in range(300)] + [(5, "x y", "a"), (None, "p q r", "b"), (7, None, "c"), (8, "", None)]
    docs = spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows], "doc_id long, text string, source string, size long, target double, shard int")
    got = mix_sources(docs, block=16, shard_words=5000).toPandas()
    again = mix_sources(docs.repartition(7), block=16, shard_words=5000).toPandas()
    cols = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, got[cols].fillna(-1).to_numpy())) == sorted(map(tuple, again[cols].fillna(-1).to_numpy()))
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    for r in got.itertuples():
        assert sum((r.runs[i + 1] - r.runs[i]) * r.runs[i + 2] for i in range(0, len(r.runs), 3)) == r.taken
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) < 0.03 * g.target.iloc[0] + 200
    assert mix_sources(docs.limit(0)).count() == 0


def test_small_sources_beside_a_large_one_are_given_whole(spark):
    from skuflow.llm.mixing import mix_sources
    rng = random.Random(10)
    rows = [(i, " ".join(["w"] * rng.randint(80, 120)), "a") for i in range(2000)]
    rows += [(10_000 + i, " ".join(["w"] * rng.randint(10, 15)), "b") for i in range(200)]
    rows += [(20_000, " ".join(["w"] * 7), "c"), (20_001, "", "d"), (20_002, " ".join(["w"] * 70), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(docs, shard_words=500).toPandas()  # about 400 shards of the large source
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    for name, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1, (name, g.taken.sum(), g.target.iloc[0])
    assert abs(got.taken.sum() - 1.5 * got["size"].sum()) <= 1


def test_highest_quotients_of_many_seats():
    from skuflow.llm.mixing import highest_quotients

    def one_by_one(votes, most, seats):
        held = [0] * len(votes)
        for _ in range(seats):
            able = [i for i, v in enumerate(votes) if v > 0 and held[i] < most[i]]
            if not able:
                break
            held[max(able, key=lambda i: (votes[i] / (2 * held[i] + 1), -i))] += 1
        return held
    rng = random.Random(11)
    for _ in range(60):
        n = rng.randint(1, 9)
        votes, most = [float(rng.choice([0, 1, 3, 3, 9, 50, 1000])) for _ in range(n)], [rng.randint(0, 400) for _ in range(n)]
        seats = rng.randint(0, 600)
        assert highest_quotients(np.array(votes), np.array(most), seats).tolist() == one_by_one(votes, most, seats)
    assert highest_quotients(np.array([6e11, 2e11]), np.array([10 ** 13, 10 ** 13]), 8 * 10 ** 11).tolist() == [6 * 10 ** 11, 2 * 10 ** 11]


# -- pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as C
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    from skuflow.session import materialize
    kept = materialize(C.toxicity(spark, docs, d), "t")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    wrong = [i for i, t in labels.items() if (i in ids) == (t == 1)]
    assert len(wrong) <= 0.05 * len(labels)
    near = materialize(C.near_duplicate(spark, kept, d), "n")
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = sorted(k for k, _, c in brute_near(rows, 5, 80) if k == c)
    assert sorted(r.doc_id for r in near.collect()) == want
    clean = materialize(C.personal_data(spark, near, d), "p")
    assert clean.count() == near.count() and clean.columns == list(C.COLUMNS)
    mixed = materialize(C.mixing(spark, clean, d), "m")
    words = lambda df: df.select(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n")).agg(F.sum("n")).first()[0]
    assert abs(words(mixed) - 1.5 * words(clean)) < 0.02 * words(clean) + 300
    coded = C.pieces(spark, mixed, d)
    from skuflow.llm.pieces import Pieces
    p, texts = Pieces(MODEL), {}
    for r in mixed.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    got = {}
    for r in coded.collect():
        got.setdefault(r.doc_id, []).append(list(r.ids))
    for i, own in texts.items():
        assert sorted(got[i]) == sorted(brute_pieces(t, p) for t in own)


def test_pipeline_edges(spark):
    import corpus_pipeline as C
    from skuflow.session import materialize
    d = "/root/testdata/sf0.001"
    for docs in (frame(spark, odd_texts(), extra=True), frame(spark, odd_texts(), extra=True).limit(0), frame(spark, odd_texts(), source=None)):
        for _, stage in C.STAGES:
            docs = materialize(stage(spark, docs, d), "edge")
        docs.count()


def test_oracles_of_the_llm_queries(spark):
    import duckdb

    from skuflow.llm.queries import ORACLE_SQL, QUERIES
    d, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        got, want = QUERIES[name](spark, d), con.sql(sql)
        assert sorted(got.columns) == sorted(want.columns), name
        pick = sorted(got.columns)
        mine = sorted(map(str, (tuple(r[c] for c in pick) for r in got.collect())))
        theirs = sorted(map(str, want.select(*pick).fetchall()))
        assert mine == theirs, name


def test_repeats_sorts_only_what_may_repeat(monkeypatch):
    """Segments that share a minimizer but no window are not sorted; of the others, only the windows that repeat."""
    from skuflow.llm import repeats
    rng = random.Random(11)
    word = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    long, twice = word(1000), word(150)
    segments = [long, word(400) + twice + word(300), twice + word(80), word(500), word(90) + twice[10:130] + word(5), b"x" * 130]
    seen = {}
    for i, s in enumerate(segments):
        for a in range(len(s) - 99):
            seen.setdefault(s[a:a + 100], []).append((i, a))
    expected = sorted(p for places in seen.values() if len(places) > 1 for p in places)
    part, at, count = repeats.repeated_stretches(segments, repeats.Windows(100))
    assert sorted((int(i), int(a) + j) for i, a, c in zip(part, at, count) for j in range(c)) == expected
    assert repeats.repeated_stretches([long, long[::-1]], repeats.Windows(100))[0].size == 0

    sizes, rows = [], repeats.repeated_rows
    monkeypatch.setattr(repeats, "repeated_rows", lambda pieces, n: sizes.append(sum(map(len, pieces))) or rows(pieces, n))
    # a block of one minimizer: five documents of which two share 150 bytes
    texts = [word(2000) + b"1" + twice + b"2" + word(2000), twice + b"3" + word(3000), word(3000), word(2500), word(2800)]
    rest = np.array([(k, k, 0, len(t) - 99) for k, t in enumerate(texts)], np.int64)
    blob = repeats._pack(np.full(len(texts), 7, np.uint64), rest, b"".join(texts))
    out = repeats._expand(100, repeats.BLOCK_BYTES)(pd.DataFrame([(0, 0, blob)], columns=["block", "gid", "blob"]))
    assert [r.tolist() for r in repeats._unpack(out["blob"][0])[0]] == [[1, 1, 0, 51]]
    assert sizes == [300]
