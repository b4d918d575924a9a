"""Exact removal of repeated byte strings by bounded Burrows-Wheeler expansion.

Removed is every byte covered by a ``length``-byte string that also starts
earlier: in a smaller doc_id, or earlier in the same document. Strings are
judged on the input and never cross documents.

How the corpus is cut so that all occurrences of a string meet in one block:

1. Equal texts are one class; only its first document is searched (in every
   other one all strings start earlier, so all bytes go).
2. Each window of ``length`` bytes is named by its smallest m-gram hash (its
   minimizer); windows in a row with one minimizer form a segment. Equal
   strings have equal minimizers. Minimizers that occur once in the corpus are
   dropped; the others' segments are dealt to blocks by minimizer. A minimizer
   with more than ``HOT`` segments is split further by the hash of the window.
3. In a block, equal segments are one class again; of the distinct ones, the
   stretches of windows whose hash is not the only one of its kind are
   joined (each ends in a terminator of its own), suffix-sorted to a depth of
   at least ``length`` and transformed (BWT). Common prefixes then come in
   increasing order by breadth-first backward extension of intervals: the
   extensions ``cw`` of an interval ``w`` are read off a wavelet matrix, and
   an interval whose right end has no value yet gets ``|w|`` there and is
   extended in turn. It stops at ``length``: rows without a value by then share
   at least ``length`` bytes with the row above. Each run of such rows is one
   repeated string; all its places but the first are removed.

Defined cases: null text counts as empty. A null id sorts after all others.
Rows with equal id and text: the first counts, the others are copies; equal
ids with different texts are ordered by the text's digest. Empty table: none.

Scale: groups of texts of bounded size (dealt by digest), blocks of bounded
size (dealt by minimizer), and between them packed arrays of hashes, segments
and spans, so nothing moves per byte of text. A task sends a text once however
many copies it holds. Whole texts are shuffled (compressed) three times
instead of being stored in between.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import partitions_for, table, text_of

LENGTH = 100
HOT = 2000
BLOCK_BYTES = 2 << 20
NULL_ID = (1 << 63) - 1
_ODD = 0x9E3779B97F4A7C15
_PLACE = (1 << 28) - 1  # texts are shorter than 256 MB


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Windows:
    """Rolling hashes of byte strings: minimizer runs and window hashes."""

    def __init__(self, length: int):
        self.length, self.gram = length, max(1, min(32, length // 3))
        self.wide = length - self.gram + 1
        self.codes = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n + 1, 1 << 16)
            self.up, self.down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
            np.multiply.accumulate(np.full(n, _ODD, np.uint64), out=self.up[1:])
            np.multiply.accumulate(np.full(n, pow(_ODD, -1, 1 << 64), np.uint64), out=self.down[1:])

    def prefix(self, raw: bytes) -> np.ndarray:
        x = np.frombuffer(raw, np.uint8)
        self._powers(len(x))
        p = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(self.codes[x] * self.up[:len(x)], out=p[1:])
        return p

    def spans(self, p: np.ndarray, size: int) -> np.ndarray:
        m = len(p) - size
        return _mix((p[size:] - p[:m]) * self.down[:m])

    def runs(self, raws: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, start, windows, minimizer, places) of each run of texts of at least ``length`` bytes,
        and the joined texts' prefix hashes with the place of each text in them.

        A window's minimizer is its leftmost m-gram with the least upper hash bits; ``places``
        counts the m-grams that serve a run, so a run that holds a string twice has at least 2.
        """
        sizes = np.array([len(x) for x in raws])
        place, count = np.cumsum(sizes) - sizes, sizes - self.length + 1
        p = self.prefix(b"".join(raws))
        grams, step = self.spans(p, self.gram), 1
        low = (grams & np.uint64(~_PLACE & 0xFFFFFFFFFFFFFFFF)) | (np.arange(len(grams), dtype=np.uint64) & np.uint64(_PLACE))
        n = len(low) - self.wide + 1
        while step * 2 <= self.wide:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        low = np.minimum(low[:n], low[self.wide - step:self.wide - step + n])
        first = np.cumsum(count) - count
        if len(raws) > 1:       # no window lies in two texts
            low = low[np.repeat(place - first, count) + np.arange(first[-1] + count[-1])]
        new = np.concatenate(([True], low[1:] != low[:-1]))
        new[first] = True
        moved = np.flatnonzero(new)
        name = grams[(low[moved] & np.uint64(_PLACE)).astype(np.int64)]
        new = np.concatenate(([True], name[1:] != name[:-1]))
        new[np.searchsorted(moved, first)] = True
        head = np.flatnonzero(new)
        start = moved[head]
        text = np.searchsorted(first, start, side="right") - 1
        return text, start - first[text], np.diff(np.append(start, len(low))), name[head], np.diff(np.append(head, len(moved))), p, place


def _together(texts, most: int = 1 << 17):
    """Lists of texts (id, digest, bytes) that are hashed in one go: short ones share the cost of a call."""
    some, held = [], 0
    for one in texts:
        if some and held + len(one[2]) > most:
            yield some
            some, held = [], 0
        some.append(one)
        held += len(one[2])
    if some:
        yield some


def suffix_order(s: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``s`` by their first ``depth`` symbols or more. ``s`` holds
    symbols 1..255 and a 0 at each of ``ends``; terminators count as different, ordered by place."""
    n = len(s)
    to_end = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    wide = np.concatenate((s, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key |= np.where(to_end >= i, wide[i:i + n], 0).astype(np.uint64) << np.uint64(8 * (7 - i))
    order = np.argsort(key)
    ended = to_end[order] < 8
    part = order[ended]
    order[ended] = part[np.lexsort((part, key[part]))]
    sorted_key = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_key[1:] != sorted_key[:-1]) | ended[1:]
    h = 8
    rank = np.empty(n, np.int64)
    while True:
        # a suffix's rank is the first place of its group, so ranks of settled suffixes stay as they are
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, n))
        rank[order] = np.repeat(first, size)
        if h >= depth:
            return order
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            return order
        rows = order[tied]
        pair = rank[rows] * np.int64(n + 1) + rank[np.minimum(rows + h, n - 1)] + 1
        by = np.argsort(pair)
        order[tied] = rows[by]
        pair = pair[by]
        new = np.ones(len(tied), bool)
        new[1:] = pair[1:] != pair[:-1]
        fresh[tied] = new
        h *= 2


class Wavelet:
    """Wavelet matrix over a byte sequence: splits many intervals into (symbol, sub-interval) at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            one = (symbols >> b) & 1
            zeros = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(1 - one, dtype=np.int32, out=zeros[1:])
            self.levels.append(zeros)
            symbols = np.concatenate((symbols[one == 0], symbols[one == 1]))

    def split(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For intervals [lo, hi): each symbol present, with the places of its sub-interval in the matrix's last order."""
        symbol = np.zeros(len(lo), np.int64)
        for zeros in self.levels:
            n0, zl, zh = zeros[-1], zeros[lo], zeros[hi]
            ol, oh = n0 + lo - zl, n0 + hi - zh
            left, right = zh > zl, oh > ol
            lo = np.concatenate((zl[left], ol[right]))
            hi = np.concatenate((zh[left], oh[right]))
            symbol = np.concatenate((symbol[left] * 2, symbol[right] * 2 + 1))
        return symbol, lo, hi


def bounded_lcp(bwt: np.ndarray, stop: int) -> np.ndarray:
    """Common prefix of each suffix row with the row above, by increasing value; rows that
    share ``stop`` or more keep ``stop``. Symbol 0 marks the terminators (all different)."""
    n = len(bwt)
    bits = max(1, int(bwt.max()).bit_length())
    wave = Wavelet(bwt, bits)
    counts = np.bincount(bwt, minlength=1 << bits)
    before = np.concatenate(([0], np.cumsum(counts)))  # first row of each symbol
    # in the wavelet matrix's last order, symbols stand by their bits from the lowest, so each has a first place there
    last = np.array(sorted(range(1 << bits), key=lambda c: int(format(c, f"0{bits}b")[::-1], 2)))
    place = np.zeros(1 << bits, np.int64)
    place[last] = np.concatenate(([0], np.cumsum(counts[last])[:-1]))
    shift = before[:-1] - place

    lcp = np.full(n + 1, stop, np.int16)
    ends = int(counts[0])
    lcp[:ends + 1] = 0
    lcp[n] = 0
    # length 1: the row of each terminator, and the rows of each symbol unless their end is the table's
    symbols = np.flatnonzero(counts[1:]) + 1
    lo, hi = before[symbols], before[symbols + 1]
    grow = lcp[hi] == stop
    lcp[hi] = 0
    lo, hi = np.concatenate((np.arange(ends), lo[grow])), np.concatenate((np.arange(1, ends + 1), hi[grow]))
    for size in range(1, stop):
        symbol, left, right = wave.split(lo, hi)
        real = symbol > 0  # nothing extends over a terminator
        symbol, left, right = symbol[real], left[real], right[real]
        left, right = left + shift[symbol], right + shift[symbol]
        grow = lcp[right] == stop
        lcp[right[grow]] = size
        lo, hi = left[grow], right[grow]
        if not len(lo):
            break
    return lcp[:n]


def repeated_rows(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places of strings of ``length`` bytes that occur more than once in the segments:
    (group, segment, offset), places of a group sharing one string."""
    sizes = np.array([len(x) for x in segments])
    joined = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(joined), bool)
    inside[ends] = False
    present = np.flatnonzero(np.bincount(joined[inside], minlength=256))
    code = np.zeros(256, np.uint8)
    code[present] = np.arange(1, len(present) + 1)
    s = np.where(inside, code[joined], 0).astype(np.uint8)
    order = suffix_order(s, ends, length)
    lcp = bounded_lcp(s[order - 1], length)
    same = lcp >= length
    member = same.copy()
    member[:-1] |= same[1:]
    rows = np.flatnonzero(member)
    group = np.cumsum(~same)[rows]
    at = order[rows]
    seg = np.searchsorted(ends, at)
    return group, seg, at - (ends[seg] - sizes[seg])


def repeated_stretches(segments: list[bytes], windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, windows) of each run of windows whose hash occurs more than once in the
    segments. Equal strings have equal hashes, so whatever lies outside the runs repeats nowhere."""
    length = windows.length
    sizes = np.array([len(x) for x in segments])
    hashes, count = windows.spans(windows.prefix(b"".join(segments)), length), sizes - length + 1
    first = np.cumsum(count) - count
    within = np.arange(int(count.sum())) - np.repeat(first, count)
    seg = np.repeat(np.arange(len(segments)), count)
    hashes = hashes[np.repeat(np.cumsum(sizes) - sizes, count) + within]
    # few windows share a cell with another one; only those are sorted
    cell = (hashes >> np.uint64(64 - max(8, (4 * len(hashes)).bit_length()))).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(cell)[cell] > 1)
    by = maybe[np.argsort(hashes[maybe])]
    same = hashes[by][1:] == hashes[by][:-1]
    hit = np.zeros(len(hashes), bool)
    hit[by[1:][same]] = hit[by[:-1][same]] = True
    at = np.flatnonzero(hit)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (within[at[1:]] == 0)
    head = np.flatnonzero(new)
    return seg[at[head]], within[at[head]], np.diff(np.append(head, len(at)))


# -- packing ------------------------------------------------------------------------------------------------------


def _pack(*arrays) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _unpack(blob: bytes) -> tuple:
    import zstandard
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _pack_sorted(x: np.ndarray) -> np.ndarray:
    """Differences of sorted hashes with their bytes regrouped, so that the leading ones compress away."""
    return np.ascontiguousarray(np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def _unpack_sorted(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(x.T).view(np.uint64).ravel(), dtype=np.uint64)


def _deal(groups: int, least: int):
    """Texts to groups by digest; a task sends each distinct text once, and later only a smaller id for it."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        press, seen, lower = zstandard.ZstdCompressor(level=1), {}, {}

        def rows(out):
            return pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(r[0][:8], "little") % groups for r in out], pa.int64()), pa.array([r[0] for r in out], pa.binary()),
                 pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.binary())], names=["gid", "digest", "k", "z"])
        for batch in batches:
            out, held = [], 0
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                if len(raw) < least:
                    continue
                digest = hashlib.sha256(raw).digest()
                if digest in seen:
                    if k < seen[digest]:
                        seen[digest] = lower[digest] = k
                    continue
                seen[digest] = k
                out.append((digest, k, press.compress(raw)))
                held += len(out[-1][2])
                if held > 4 << 20:
                    yield rows(out)
                    out, held = [], 0
            if out:
                yield rows(out)
        if lower:
            yield rows([(d, k, None) for d, k in lower.items()])
    return run


def _texts(pdf: pd.DataFrame):
    """(first id, digest, text bytes) of each distinct text of a group, in order of digest."""
    import zstandard
    press = zstandard.ZstdDecompressor()
    first = pdf.groupby("digest", sort=True)["k"].min()
    bodies = dict(zip(pdf["digest"], pdf["z"])) if pdf["z"].notna().all() else {d: z for d, z in zip(pdf["digest"], pdf["z"]) if z is not None}
    for digest, k in first.items():
        yield int(k), digest, press.decompress(bodies[digest])


def _names(length: int, deals: int):
    """A group's minimizers, counted, packed for each deal."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        windows, found = Windows(length), []
        for some in _together(_texts(pdf)):
            found.append(windows.runs([raw for _, _, raw in some])[3:5])
        names, which = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        counts = np.bincount(which, np.concatenate([f[1] for f in found])).astype(np.int64)
        deal, out = names % np.uint64(deals), []
        by = np.argsort(deal, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], np.diff(deal[by]) != 0)))
        for rows in np.split(by, cut[1:]):
            out.append((int(deal[rows[0]]), int(pdf["gid"].iloc[0]),
                        _pack(_pack_sorted(names[rows]), np.minimum(counts[rows], 0xFFFF).astype(np.uint16))))
        return pd.DataFrame(out, columns=["deal", "gid", "blob"])
    return run


def _repeated(hot: int):
    """Of a deal's minimizers, those that occur more than once, back to each group that has them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        gids = pdf["gid"].to_numpy()
        parts = [_unpack(b) for b in pdf["blob"]]
        parts = [(_unpack_sorted(p[0]), p[1]) for p in parts]
        sizes = [len(p[0]) for p in parts]
        names, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        total = np.bincount(which, np.concatenate([p[1] for p in parts]).astype(np.int64)).astype(np.int64)
        splits = np.where(total > hot, -(-total // max(1, hot // 2)), 1)
        owner, keep = np.repeat(np.arange(len(gids)), sizes), total[which] > 1
        out = []
        kept, owners = which[keep], owner[keep]
        cut = np.searchsorted(owners, np.arange(len(gids) + 1))
        for i, gid in enumerate(gids):
            mine = kept[cut[i]:cut[i + 1]]
            if len(mine):
                out.append((int(gid), _pack(_pack_sorted(names[mine]), splits[mine])))
        return pd.DataFrame(out, columns=["gid", "blob"])
    return run


def _segments(length: int, blocks: int):
    """A group's segments of repeated minimizers, packed for each block."""
    def run(texts: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        columns = ["block", "gid", "blob"]
        if not len(texts) or not len(blobs):
            return pd.DataFrame([], columns=columns)
        got = [_unpack(b) for b in blobs["blob"]]
        known = np.concatenate([_unpack_sorted(g[0]) for g in got])
        by = np.argsort(known)
        known, splits = known[by], np.concatenate([g[1] for g in got])[by]
        windows, names, rows, bodies = Windows(length), [], [], []
        for some in _together(_texts(texts)):
            raws = [raw for _, _, raw in some]
            text, start, count, name, _, p, place = windows.runs(raws)
            at = np.minimum(np.searchsorted(known, name), len(known) - 1)
            hit = np.flatnonzero(known[at] == name)
            if not len(hit):
                continue
            split = splits[at[hit]]
            hot = hit[split > 1]
            text, start, count, name = [np.concatenate((x[hit[split == 1]], x[hot])) for x in (text, start, count, name)]
            if len(hot):        # each window of a hot minimizer for itself, in the part of its hash
                many, cold = count[-len(hot):], len(count) - len(hot)
                parts = np.repeat(split[split > 1], many).astype(np.uint64)
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                text, start, name = [np.concatenate((x[:cold], np.repeat(x[cold:], many))) for x in (text, start, name)]
                start[cold:] += step
                part = windows.spans(p, length)[place[text[cold:]] + start[cold:]] % parts + np.uint64(1)
                name[cold:] += part * np.uint64(_ODD)
                count = np.concatenate((count[:cold], np.ones(len(step), count.dtype)))
            ids = np.array([(k, int.from_bytes(digest[:7], "big")) for k, digest, _ in some], np.int64)
            names.append(name)
            rows.append(np.column_stack((ids[text], start, count)))
            bodies += [raws[i][a:b] for i, a, b in zip(text.tolist(), start.tolist(), (start + count + length - 1).tolist())]
        if not names:
            return pd.DataFrame([], columns=columns)
        names, rest = np.concatenate(names), np.concatenate(rows)
        block, out = _mix(names) % np.uint64(blocks), []
        by = np.argsort(block, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], np.diff(block[by]) != 0)))
        for part in np.split(by, cut[1:]):
            blob = _pack(names[part], rest[part], b"".join([bodies[i] for i in part.tolist()]))
            out.append((int(block[part[0]]), int(texts["gid"].iloc[0]), blob))
        return pd.DataFrame(out, columns=columns)
    return run


def _expand(length: int, block_bytes: int):
    """A block's repeated strings: runs of windows (id, tie, start, windows) that start earlier elsewhere."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, rests, gids, bodies, windows = [], [], [], [], Windows(length)
        for gid, blob in zip(pdf["gid"], pdf["blob"]):
            name, rest, body = _unpack(blob)
            size = rest[:, 3] + length - 1
            end = np.cumsum(size)
            bodies += [body[a:b] for a, b in zip((end - size).tolist(), end.tolist())]
            names.append(name), rests.append(rest), gids.append(np.full(len(name), gid))
        name, rest, gid = np.concatenate(names), np.concatenate(rests), np.concatenate(gids)
        # places in corpus order; the first place of each distinct segment stands for it
        by = np.lexsort((rest[:, 2], rest[:, 1], rest[:, 0]))
        distinct, first, late = {}, [], []
        for i in by.tolist():
            if bodies[i] in distinct:
                late.append(i)
            else:
                distinct[bodies[i]] = len(first)
                first.append(i)
        runs = [(gid[late], rest[late])]
        first = np.array(first)
        # segments of a minimizer stay together; blocks of bounded size
        first = first[np.lexsort((first, name[first]))]
        edge = np.flatnonzero(np.concatenate(([True], name[first][1:] != name[first][:-1])))
        sizes, chunk, held = rest[first, 3] + length, [], 0
        chunks = []
        for rows, size in zip(np.split(first, edge[1:]), np.add.reduceat(sizes, edge).tolist()):
            if chunk and held + size > block_bytes:
                chunks.append(np.concatenate(chunk))
                chunk, held = [], 0
            chunk.append(rows)
            held += size
        chunks.append(np.concatenate(chunk))
        place = np.empty(len(name), np.int64)
        place[by] = np.arange(len(by))
        for rows in chunks:
            # only what may repeat is sorted and transformed
            part, at, count = repeated_stretches([bodies[i] for i in rows.tolist()], windows)
            if not len(part):
                continue
            part = rows[part]
            pieces = [bodies[i][a:a + c + length - 1] for i, a, c in zip(part.tolist(), at.tolist(), count.tolist())]
            group, seg, off = repeated_rows(pieces, length)
            if not len(group):
                continue
            own = part[seg]
            # corpus order of single windows: id, tie, then start plus offset
            start = rest[own, 2] + at[seg] + off
            order = np.lexsort((start, rest[own, 1], rest[own, 0], group))
            late_row = np.concatenate(([False], group[order][1:] == group[order][:-1]))
            own, start = own[order][late_row], start[order][late_row]
            by_run = np.lexsort((start, own))
            own, start = own[by_run], start[by_run]
            new = np.concatenate(([True], (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)))
            head = np.flatnonzero(new)
            found = rest[own[head]].copy()
            found[:, 2] = start[head]
            found[:, 3] = np.diff(np.append(head, len(own)))
            runs.append((gid[own[head]], found))
        gid, rest = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
        by = np.argsort(gid, kind="stable")
        if not len(by):
            return pd.DataFrame([], columns=["gid", "blob"])
        cut = np.flatnonzero(np.concatenate(([True], np.diff(gid[by]) != 0)))
        return pd.DataFrame([(int(gid[p[0]]), _pack(rest[p])) for p in np.split(by, cut[1:])], columns=["gid", "blob"])
    return run


def _strip(length: int):
    """Of each text that loses bytes: what is left, and the removed runs."""
    def run(texts: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        columns = ["digest", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        if not len(texts) or not len(blobs):
            return pd.DataFrame([], columns=columns)
        rest = np.concatenate([_unpack(b)[0] for b in blobs["blob"]])
        rest = rest[np.lexsort((rest[:, 2], rest[:, 1], rest[:, 0]))]
        edge = np.flatnonzero(np.concatenate(([True], (np.diff(rest[:, 0]) != 0) | (np.diff(rest[:, 1]) != 0))))
        mine = {(int(r[0, 0]), int(r[0, 1])): r for r in np.split(rest, edge[1:])}
        out = []
        for k, digest, raw in _texts(texts):
            r = mine.get((k, int.from_bytes(digest[:7], "big")))
            if r is None:
                continue
            start, end = r[:, 2], np.maximum.accumulate(r[:, 2] + r[:, 3] + length - 1)
            new = np.concatenate(([True], start[1:] > end[:-1]))
            a, b = start[new], np.append(end[:-1][new[1:]], end[-1])
            keep = zip([0, *b.tolist()], [*a.tolist(), len(raw)])
            left = b"".join([raw[x:y] for x, y in keep])
            out.append((digest, int((b - a).sum()), len(a), hashlib.sha256(left).hexdigest(), np.stack((a, b), 1).ravel().tolist(), left))
        return pd.DataFrame(out, columns=columns)
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES, with_kept: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, spans (flat pairs: start, end of each removed run; bytes), and with
    ``with_kept`` the bytes that are left (kept; null where nothing was removed)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    rows = docs.select(key.alias("k"), text_of().alias("text"))
    groups = partitions_for(docs)
    dealt = rows.mapInArrow(_deal(groups, length), "gid long, digest binary, k long, z binary")

    names = dealt.groupBy("gid").applyInPandas(_names(length, groups), "deal long, gid long, blob binary")
    repeated = names.groupBy("deal").applyInPandas(_repeated(hot), "gid long, blob binary")
    segments = (dealt.groupBy("gid").cogroup(repeated.groupBy("gid"))
                .applyInPandas(_segments(length, groups), "block long, gid long, blob binary"))
    runs = segments.groupBy("block").applyInPandas(_expand(length, block_bytes), "gid long, blob binary")
    schema = "digest binary, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"
    changed = dealt.groupBy("gid").cogroup(runs.groupBy("gid")).applyInPandas(_strip(length), schema)
    if not with_kept:
        changed = changed.drop("kept")

    members = (rows.select("k", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
               .groupBy("k", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("copies")))
    classes = members.groupBy("digest").agg(F.min("k").alias("first")).join(changed, "digest", "left")
    each = (members.join(classes, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    first = (F.col("k") == F.col("first")) & (F.col("copy") == 1)
    long = F.col("n_bytes") >= length
    n_removed = F.when(first, F.coalesce("n_removed", F.lit(0))).when(long, F.col("n_bytes")).otherwise(F.lit(0))
    same = F.lower(F.hex("digest"))
    out = each.select(
        F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "n_bytes", n_removed.cast("long").alias("n_removed"),
        F.when(first, F.coalesce("n_spans", F.lit(0))).when(long, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(first, F.coalesce("kept_sha256", same)).when(long, F.sha2(F.lit(""), 256)).otherwise(same).alias("kept_sha256"),
        F.when(first, F.coalesce("spans", F.array().cast("array<long>"))).when(long, F.array(F.lit(0).cast("long"), F.col("n_bytes")))
        .otherwise(F.array().cast("array<long>")).alias("spans"),
        *([F.when(first, F.col("kept")).when(long, F.lit(b"")).alias("kept")] if with_kept else []))
    return out


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


# DuckDB: texts as hex, a string of 100 bytes is 200 hex digits at an even place.
ORACLE_OP2 = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM d WHERE length(h) >= 200),
g AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS w FROM p),
f AS (SELECT w, min({'d': doc_id, 's': s}) AS first FROM g GROUP BY w HAVING count(*) > 1),
r AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS prev FROM g JOIN f USING (w) WHERE first <> {'d': doc_id, 's': s}),
i AS (SELECT doc_id, s, sum(CASE WHEN prev IS NULL OR s > prev + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r),
m AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY 1, 2),
x AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM m GROUP BY 1)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, n_spans + 1),
    lambda j: substr(h, 2 * (CASE WHEN j = 0 THEN 0 ELSE ends[j] END) + 1,
      2 * ((CASE WHEN j = n_spans THEN length(h) // 2 ELSE starts[j + 1] END) - (CASE WHEN j = 0 THEN 0 ELSE ends[j] END)))), '') END)) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)"""
