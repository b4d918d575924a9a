"""Jaccard join, conversation repair and lexical search on small fixtures, against brute force."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ", k long, n long, c long, band int, label long, words string, bucket long, q long, term string, rank int, g string, step long, edit string"


def frame(spark, rows, schema=DOC, clash=True):
    extra = (1, 2, 3, 4, 5, "w", 6, 7, "t", 8, "g", 9, "e")
    width = len(schema.split(","))
    rows = [tuple(r) + (None,) * (width - len(r)) + (extra if clash else ()) for r in rows]
    return spark.createDataFrame(rows, schema + (CLASH if clash else ""))


# -- 11 Jaccard join ---------------------------------------------------------------------------------------------


def shingles(text, words):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return set()
    size = min(words, len(ws))
    return {tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)}


def brute_components(rows, words, percent):
    """Rows (id, text) -> sorted (id, set size, smallest id reachable)."""
    order = lambda i: (i is None, i or 0)
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d, key=order)
    return sorted(((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)), key=lambda r: (order(r[0]), r[1], order(r[2])))


def near_texts(seed, groups=12, size=9):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([4, 12, 30, 80, 200]))]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(base) // 20])):
                at = rng.randrange(len(copy))
                rng.choice([lambda: copy.__setitem__(at, word()), lambda: copy.insert(at, word()), lambda: len(copy) > 1 and copy.pop(at)])()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,percent,words", [(1, 90, 3), (2, 80, 5), (3, 95, 1)])
def test_jaccard_components_brute_force(spark, seed, percent, words):
    from skuflow.llm.parity_join import jaccard_components
    texts = near_texts(seed)
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n\x0b"), (1003, "Ab"), (1004, "aB"), (1005, texts[0]), (1005, texts[1]), (0, texts[2]), (None, texts[3]),
             (None, "no id"), (1006, "naïve CAFÉ 日本 \U0001f600 x"), (1007, " ".join(f"w{i % 5000}" for i in range(20_000))),
             (1008, " ".join(f"w{i % 5000}" for i in range(20_000)) + " end")]
    got = jaccard_components(frame(spark, rows), words, percent, block_bytes=4000).collect()
    order = lambda i: (i is None, i or 0)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=lambda r: (order(r[0]), r[1], order(r[2])))
    assert got == brute_components(rows, words, percent)


def test_jaccard_empty(spark):
    from skuflow.llm.parity_join import jaccard_components
    assert jaccard_components(frame(spark, [])).collect() == []


def test_sketches_bound_differences():
    from skuflow.llm.parity_join import Bands, differences, linked, sketch
    rng = np.random.default_rng(5)
    for percent in (50, 80, 90, 97):
        bands = Bands(percent)
        for _ in range(60):
            n = int(rng.integers(1, 400))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            cut = int(rng.integers(0, max(1, len(a) // 5) + 1))
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, cut + 2)), dtype=np.uint64)]))
            if not len(b):
                continue
            apart = len(np.setxor1d(a, b))
            both = len(np.intersect1d(a, b))
            links = 100 * both >= percent * (len(a) + len(b) - both)
            assert links == linked(a, b, percent) == (apart <= differences(len(a) + len(b), percent))
            if links and apart:
                low, high = sorted((a, b), key=len)
                band, words = bands.places(len(high))[0]
                assert (band, words) in bands.places(len(low)) and words > apart - 1
                x, y = sketch(a, words), sketch(b, words)
                assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= apart and (x == y).any()


def test_open_bucket_blocks_find_every_link(spark):
    """Copies that link only along a chain, in one bucket with others that link with none: blocks of a few members."""
    from skuflow.llm.parity_join import jaccard_components
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(40):                       # neighbours differ in two words, ends in many
        texts.append([f"x{i}_{j}" if j // 2 == i % 30 else w for j, w in enumerate(base)])
    texts += [base[:50] + [f"y{rng.random()}" for _ in range(10)] for _ in range(20)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, rows), 1, 90, block_bytes=2000).collect())
    assert got == brute_components(rows, 1, 90)


# -- 12 conversation repair --------------------------------------------------------------------------------------


WS = " \t\n\x0b\x0c\r"


def damaged(rows):
    said = lambda x: " " if x is None else str(x)
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{said(c)}:{said(t)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """Rows (turn, role, text) in order, by a search over all edit strings, cheapest and then least first."""
    turns = {t for t, _, _ in rows if t is not None}
    kinds, seen = [], set()
    for _, role, text in rows:
        s = text.strip(WS)
        kinds.append("blank" if not s else "duplicate" if (role, text) in seen else "truncated" if s[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            break
        then = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", i, then))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last))
            if kinds[i] not in ("blank", "duplicate"):
                late = 3 * (kinds[i] == "truncated")
                if initials[i] and last + initials[i] in ("s", "u", "su", "ua", "au"):
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, initials[i]))
                heapq.heappush(heap, (cost + 3 + late, audit + "R", i + 1, then))
    left, out, last = list(rows), [], ""
    for edit in audit:
        then = "a" if last == "u" else "u"
        _, role, text = (None, None, "") if edit == "I" else left.pop(0)
        if edit != "D":
            last = role[:1] if edit == "K" else then
            out.append((role if edit == "K" else {"u": "user", "a": "assistant"}[then]) + ":" + text)
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": kinds.count("blank"), "duplicate": kinds.count("duplicate"),
            "truncated": kinds.count("truncated"), "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def brute_report(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((t, role, text))
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]
    return {c: brute_repair(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))) for c, v in out.items()}


def odd_conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "ä"])
            text = rng.choice(["Yes.", "No!", "Well", "ok?\n", "", " \t\x0b", None, f"t{rng.random()}.", "é ", "x" * 3000 + "."])
            rows.append((c, rng.choice([t, t, t, 3 * t, t // 2, None]), role, text))
    rows += rng.sample(rows, 12) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None)]
    rows += [(500, t, "user", "again.") for t in range(70)] + [(501, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(131)]
    return rows


@pytest.mark.parametrize("seed,segment", [(1, 4096), (2, 3), (3, 1)])
def test_repair_brute_force(spark, seed, segment):
    from skuflow.llm.repair import conversation_id, repair_report
    rows = odd_conversations(seed)
    said = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.asDict() for r in repair_report(df, segment).withColumn("conv_id", conversation_id("long")).collect()}
    want = brute_report(said)
    assert got.keys() == want.keys()
    for c, w in want.items():
        assert {k: got[c][k] for k in w} == w, c


def test_repair_query(spark, tmp_path):
    from skuflow.llm.repair import op12_conversation_repair
    rows = odd_conversations(7) + [(c, 0, "user", "Hi.") for c in range(2000, 2060)]
    frame(spark, rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.asDict() for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    want = brute_report(damaged(rows))
    assert got.keys() == {r[0] for r in rows} and len(want) < len(got)
    empty = {**dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    for c, g in got.items():
        assert {k: g[k] for k in empty} == want.get(c, empty), c


def test_repair_edits_are_the_repaired_rows(spark):
    from skuflow.llm.repair import repair
    rows = [("c", 2, "assistant", "B."), ("c", 0, "system", "S."), ("c", 1, "assistant", "A."), ("c", 3, "user", ""), ("d", 0, "user", "Q?")]
    got = repair(frame(spark, rows, "conv_id string, turn long, role string, text string")).collect()
    assert [(r.g, r.edit, r.role, r.text) for r in sorted(got, key=lambda r: (r.g, r.step))] == [
        ("=c", "K", "system", "S."), ("=c", "R", "user", "A."), ("=c", "K", "assistant", "B."), ("=c", "D", "user", ""),
        ("=d", "K", "user", "Q?"), ("=d", "I", "assistant", "")]
    assert repair(frame(spark, [], "conv_id string, turn long, role string, text string")).collect() == []


def test_powers_match_steps():
    from skuflow.llm.repair import END, NEVER, _on, advance, power, product, unroll
    rng = random.Random(3)
    for _ in range(100):
        runs = [(rng.choice("suaoSUAOx"), rng.choice([1, 1, 2, 3, 7, 40])) for _ in range(rng.randint(1, 6))]
        v = END
        for symbol, count in reversed(runs):
            w = v
            for _ in range(count):
                w = _on(power(symbol, 0), w)
            v = advance(symbol, count, v)
            assert v == w
        assert _on(product(runs), END) == v and max(v) < NEVER
        cost = {"K": 0, "R": 3, "D": 4, "I": 3}
        edits, states = unroll(runs, END)
        flat = "".join(s * n for s, n in runs)
        for s in range(4):
            spent, left = END[states[s]], list(flat)
            for e in edits[s]:
                spent += cost[e]
                if e != "I":
                    spent += 3 * (left.pop(0).isupper() and e != "D")
            assert spent == v[s] and not left


# -- 13 lexical search -------------------------------------------------------------------------------------------


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, k=10):
    split = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_all, l_all = len(split), sum(n for *_, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(terms(text)), []
        for d, c, n in split:
            m = 25 + 75 * n * n_all // l_all
            s = sum(r * math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, r in asked.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def odd_corpus(seed, n=700):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('abcdé日')}{i}" for i in range(300)]
    share = [1 / (i + 1) for i in range(300)]
    text = lambda size: rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, share, k=size))
    docs = [(7 * i % n, text(rng.choice([1, 3, 10, 40, 120]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " .,\x00!"), (None, text(30)), (None, text(5)), (5, "same id " + text(9)), (n + 3, text(6000)),
             *((n + 10 + i, "tie a0 b1 tie") for i in range(30)), (n + 50, "A0 a0É   naïve-naïve")]
    items = [(i, text(rng.choice([1, 4, 12, 40]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "?!"), (103, "absent terms"), (104, "tie"), (105, "A0 a0 a0 TIE"), (0, text(3)), (None, text(4)), (106, "naïve é \U0001f600")]
    return docs, items


@pytest.mark.parametrize("seed,shard_docs", [(1, 50), (2, 1 << 15)])
def test_search_brute_force(spark, seed, shard_docs, monkeypatch):
    from skuflow.llm import lexical
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical, "BLOCK", 8)
    monkeypatch.setattr(lexical, "ITEMS", 9)
    docs, items = odd_corpus(seed)
    index = lexical.materialize(lexical.build_index(frame(spark, docs).repartition(3)), "test-index")
    got = lexical.search(index, frame(spark, items, "item_id long, text string")).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=str) == brute_search(docs, items)


def test_search_rejects_blocks_unopened():
    from skuflow.llm.lexical import Heap, Reader, Shard, _BODY, _HEAD, _rank, weight
    rng = random.Random(4)
    shard = Shard()
    docs = []
    for i in range(3000):
        text = " ".join(["the"] * rng.choice([0, 1, 2, 5]) + (["rare"] * 8 if i % 400 == 7 else []) + [f"w{rng.randint(0, 50)}" for _ in range(20)])
        docs.append((i, text)), shard.add(i, text)
    x = shard.packed()
    assert set(x) == set(_HEAD + _BODY)
    wanted = {b"the": 0, b"rare": 1, b"w3": 2}
    reader = Reader(x, wanted, x["n_docs"], x["n_terms"])
    df = dict(zip(x["terms"].split(b"\n"), np.frombuffer(x["df"], "<u4")))
    heap, stats = Heap(5), Counter()
    _rank(reader, [(i, weight(3000, int(df[t]))) for t, i in wanted.items()], heap, stats)
    assert [(d, -s) for s, _, d in heap.rows] == [(d, s) for _, _, d, s in sorted(brute_search(docs, [(0, "the rare w3")], 5), key=lambda r: r[1])]
    assert stats["skipped"] > 20 and stats["essential"] + stats["other"] + stats["skipped"] == sum(hi - lo for lo, hi, _ in reader.lists.values())


def test_search_empty_tables(spark):
    from skuflow.llm import lexical
    none, some = frame(spark, []), frame(spark, [(1, "a b")])
    items = frame(spark, [(1, "a")], "item_id long, text string")
    index = lexical.materialize(lexical.build_index(none), "test-index")
    assert lexical.search(index, items).collect() == []
    index = lexical.materialize(lexical.build_index(some), "test-index")
    assert lexical.search(index, frame(spark, [], "item_id long, text string")).collect() == []


# -- 3 cutting texts ---------------------------------------------------------------------------------------------


def test_chunks_lose_nothing_and_agree_with_the_pattern():
    from skuflow.llm.pieces import CHUNK, SPACE, chunks_of
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("ab  \n\t.é▁ 日") for _ in range(rng.randint(0, 12)))
        chunks = chunks_of(text)
        assert "".join(chunks) == (SPACE + text.replace(" ", SPACE) if text else "")
        assert chunks == (CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else [])


def test_planes_and_ragged_round_trip():
    from skuflow.llm.pieces import _from_planes, _planes, _ragged
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 31, 1000)
    assert (_from_planes(_planes(x)) == x).all() and len(_from_planes(_planes(x[:0]))) == 0
    starts, sizes = rng.integers(0, 100, 20), rng.integers(0, 5, 20)
    assert _ragged(starts, sizes).tolist() == [s + i for s, n in zip(starts, sizes) for i in range(n)]
    assert len(_ragged(starts[:0], sizes[:0])) == 0
