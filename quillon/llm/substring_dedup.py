"""Near-duplicate passages by compact windows.

The tokens of a text are its `shingle`-word shingles, and a passage is `length` of them (min_words
words) or more. For each of `functions` hash functions the Cartesian tree over the hashed tokens
groups subsequences by their minimum: a node at c with subtree l..r is the minimum of all
subsequences that hold c and stay inside l..r, its compact window. Only nodes whose subtree spans
`length` tokens matter. They are keyed by function and minimum, so that two passages of similarity
s share a node's key in each function with probability s, for every position.

Texts that share a key are candidates. The first round pairs each text with the first one of its
keys; windows of all functions that such a pair shares are joined as intervals, and the pair goes
on where `agree` of them overlap at one place in both texts: a pair of similarity 0.8 does with
probability 0.998, equal passages always do. Candidates are verified on the shingle sets of all
windows of `length` tokens that hold a shared minimum, at every offset, and a verified passage
takes in all of them. Verified passages are contracted to groups, and buckets that still hold
different groups are resolved: windows are dropped in which fewer than `agree` functions have an
open window, and those that have too few shingles of any other open text to be similar to one. Of
the others each is dealt by its key and by each of its rarest shingles that others have, of which
similar windows have one in common whatever else they differ in. So texts that share a frequent
line, but not what stands beside it, don't meet. The texts of such a finer bucket meet one of it,
and finally all its pairs that are still in different groups are verified, so that no bucket's
first member hides a link.

Equal texts are one text in all of this and are brought back at the end.

Result: one row per passage of a document that another document has too: doc_id, first_word,
end_word, class_id (smallest doc_id reachable over verified passages), n_links (other documents of
its class). Null or short texts have no passages; rows without an id are left out; a passage
repeated only under one id is not reported. Repeated ids with different texts are each looked at.
A passage that a text repeats is reported where it comes first, and elsewhere as far as found. Extra
columns are ignored. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from quillon.llm import words as W
from quillon.llm.buckets import crowded_ranges, shared_members
from quillon.llm.components import components
from quillon.llm.near_dedup import small_or_not
from quillon.session import discard, materialize, ship_package

U = W.U
#: A window's place is one number: its minimum's token, and how far it reaches to either side.
REACH_BITS = 10
WINDOW = "key long, doc long, place long"
LINKS = "doc long, other long, first int, end int, o_first int, o_end int, n_words int, o_n_words int"
#: One text in so many shows which keys are crowded.
SAMPLE = 16


def sliding_minima(v, length):
    """Position of the least value of every window of length values, the leftmost among equals."""
    n = len(v) - length + 1
    bits = U(max(int(len(v)).bit_length(), 1))
    low = (U(1) << bits) - U(1)
    packed = (v & ~low) | np.arange(len(v), dtype=U)
    blocks = -(-len(v) // length)
    full = np.full(blocks * length, ~U(0), U)
    full[: len(v)] = packed
    grid = full.reshape(blocks, length)
    before = np.minimum.accumulate(grid, 1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[length - 1 : length - 1 + n]) & low).astype(np.int64)


def cartesian_windows(at, value, lo, hi):
    """First and last position of the subtrees of the nodes at positions `at`, in order, of one text lo..hi.

    `at` holds every node whose subtree has some least size. Ancestors of such nodes are such
    nodes, so the tree over them alone gives the whole tree's subtrees. Among equal values the
    first is the root.
    """
    left, right, stack = [lo] * len(at), [hi] * len(at), []
    for i, v in enumerate(value):
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    return left, right


def _hashed(x, f):
    return W.mix64(x * U(2 * f + 1) + W.mix64(np.array([f + 1], U))[0])


def compact_windows(c, shingle, length, functions):
    """(row, first token of the row, l, c, r, key, context) arrays of a chunk, one tuple a function.

    l..r are the windows of `length` tokens of which c is the minimum: the first of them begins and
    the last ends where the subtree does, unless it is cut by c itself. In a run of one token, which
    would have a node at each place, the run's last node stands for all windows that hold it, and its
    first for those inside the run; texts with such nodes get their subtrees from the tree. context is
    a hash of all tokens of the windows that a node is the minimum of.
    """
    x = W.windows(c.hashes, shingle)
    n = len(x) - length + 1
    if n <= 0:
        return
    begin = c.ptr[:-1]
    end = np.maximum(c.ptr[1:] - shingle + 1, begin)
    row = np.repeat(np.arange(len(begin)), np.diff(c.ptr))[: len(x)]
    starts = np.flatnonzero(np.arange(n) + length <= end[row[:n]])
    if not len(starts):
        return
    low = (U(1) << U(max(int(len(x)).bit_length(), 1))) - U(1)
    differs = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
    in_run = np.zeros(len(x), bool)
    in_run[1:] = ~differs
    in_run[:-1] |= ~differs
    new = np.flatnonzero(np.concatenate(([True], differs)))
    last = np.append(new[1:], len(x)) - 1
    power, inverse = W.powers(len(x) + 1)
    total = np.zeros(len(x) + 1, U)
    np.cumsum(x * power[: len(x)], out=total[1:])
    for f in range(functions):
        v = _hashed(x, f)
        least = sliding_minima(v, length)[starts]
        at_run = np.flatnonzero(in_run[least])
        if len(at_run):
            run = np.searchsorted(new, least[at_run], "right") - 1
            least[at_run] = np.where(last[run] - starts[at_run] < length, last[run], new[run])
        edge = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        at, s0, s1 = least[edge], starts[edge], starts[np.append(edge[1:], len(starts)) - 1] + length
        of = row[at]
        left, right = s0, s1 - 1
        if len(at_run):
            left, right = left.copy(), right.copy()
            for i in np.unique(of[in_run[at]]).tolist():
                a, b = np.searchsorted(of, (i, i + 1))
                left[a:b], right[a:b] = cartesian_windows(at[a:b].tolist(), (v[at[a:b]] & ~low).tolist(), int(begin[i]), int(end[i]) - 1)
        key = (W.mix64(v[at] + U(f)) & ~U(7)) | U(f & 7)
        context = W.mix64((total[s1] - total[s0]) * inverse[s0] + W.mix64((s1 - s0).astype(U)))
        yield of, begin[of], left, at, right, key, context


def _window_batches(batches, shingle, length, functions):
    for batch in batches:
        ids = batch.column("doc").to_numpy(zero_copy_only=False)
        for c in W.chunks(batch.column("text")):
            for of, begin, l, at, r, key, context in compact_windows(c, shingle, length, functions):
                # equal windows of a text count once, so loops stay small
                same = W.mix64(key ^ context) ^ W.mix64(of.astype(U))
                i = np.sort(np.unique(same, return_index=True)[1])
                reach = [np.minimum(q[i], length - 1).astype(np.int64) for q in (at - l, r - at)]
                place = (at - begin)[i] << 2 * REACH_BITS | reach[0] << REACH_BITS | reach[1]
                yield pa.RecordBatch.from_arrays([pa.array(key[i].view(np.int64)), pa.array(ids[c.lo + of[i]].astype(np.int64)), pa.array(place)], ["key", "doc", "place"])


def _unpacked(place, length):
    """The minimum's token of windows, and the first and last start of `length` tokens that it is the minimum of."""
    c, mask = place >> 2 * REACH_BITS, (1 << REACH_BITS) - 1
    return c, c - (place >> REACH_BITS & mask), c + (place & mask) - length + 1


def _flat(lists, *fields):
    """Row of each element of a list<struct> column, and its fields as arrays."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    return np.repeat(np.arange(len(lists)), sizes), *(flat.field(f).to_numpy(zero_copy_only=False) for f in fields)


def overlapping(pair, s0, s1, t0, t1, length, step=2_000_000):
    """For each rectangle (starts s0..s1 by t0..t1) of a pair: how many of the pair hold s0 and meet t0..t1.

    Rectangles with a common point have the one that starts last among them, and that one counts
    them all.
    """
    big = np.int64(1) << 40
    order = np.argsort(pair * big + s0, kind="stable")
    key = (pair * big + s0)[order]
    lo, hi = np.searchsorted(key, key - (length - 1)), np.searchsorted(key, key, "right")
    s1, t0, t1, base = s1[order], t0[order], t1[order], s0[order]
    out = np.zeros(len(order), np.int64)
    upto = np.concatenate(([0], np.cumsum(hi - lo)))
    a = 0
    while a < len(order):
        b = max(int(np.searchsorted(upto, upto[a] + step, "right")) - 1, a + 1)
        i = np.repeat(np.arange(a, b), (hi - lo)[a:b])
        j = np.arange(len(i)) - np.repeat(upto[a:b] - upto[a], (hi - lo)[a:b]) + np.repeat(lo[a:b], (hi - lo)[a:b])
        out[a:b] = np.bincount(i[(s1[j] >= base[i]) & (t0[j] <= t1[i]) & (t1[j] >= t0[i])] - a, minlength=b - a)
        a = b
    back = np.empty_like(out)
    back[order] = out
    return back


def _agreeing_batches(batches, length, agree):
    """The pairs of which `agree` windows or more overlap at one place in both texts."""
    for batch in batches:
        pair, mine, theirs = _flat(batch.column("anchors"), "place", "other")
        (c, s0, s1), (h, t0, t1) = _unpacked(mine, length), _unpacked(theirs, length)
        most = np.zeros(batch.num_rows, np.int64)
        if len(pair):
            np.maximum.at(most, pair, overlapping(pair, s0, s1, t0, t1, length))
        yield batch.filter(pa.array(most >= agree))


def _tokens(column, shingle):
    """All tokens of a text column, and where each row's begin. Equal texts are split once."""
    texts = column.dictionary_encode()
    each = [x for c in W.chunks(texts.dictionary) for x in W.shingle_rows(c, shingle)]
    rows = [each[i] for i in texts.indices.to_pylist()]
    return np.concatenate([*rows, np.zeros(0, U)]), np.concatenate(([0], np.cumsum([len(x) for x in rows], dtype=np.int64)))


def _near_repeats(x, offsets, length):
    """Running count of tokens that the same row has less than `length` tokens before."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    # hash and place in one number: equal hashes lie together in order after one sort
    low = (U(1) << U(max(int(len(x)).bit_length(), 1))) - U(1)
    order = np.sort((W.mix64(x ^ W.mix64(row.astype(U) + U(1))) & ~low) | np.arange(len(x), dtype=U))
    place = (order & low).astype(np.int64)
    same = ((order[1:] ^ order[:-1]) & ~low) == 0
    close = np.zeros(len(x) + 1, np.int64)
    close[place[1:][same & (place[1:] - place[:-1] < length)] + 1] = 1
    return np.cumsum(close)


def _similar(a, b, num, den):
    a, b = set(a.tolist()), set(b.tolist())
    both = len(a & b)
    return both > 0 and den * both >= num * (len(a) + len(b) - both)


class Verifier:
    """Passages of pairs of texts around places (c, h) where their windows have one minimum."""

    def __init__(self, ta, tb, shingle, length, num, den, local=False):
        """local: look only at windows that hold an anchor, not along the whole texts."""
        self.length, self.num, self.den, self.local = length, num, den, local
        self.need = -(-2 * num * length // (num + den))
        (self.x, self.xo), (self.y, self.yo) = _tokens(ta, shingle), _tokens(tb, shingle)
        if not local:
            self.rx, self.ry = _near_repeats(self.x, self.xo, length), _near_repeats(self.y, self.yo, length)

    def _repeats(self, running, starts):
        return running[np.minimum(starts + self.length, len(running) - 1)] > running[np.minimum(starts, len(running) - 1)]

    def passages(self, p, c, h):
        """(pair, first and end token in x, first and end token in y), from anchors (p, c, h)."""
        if self.local:
            return self._around(p, c, h)
        shift = c - h
        half = np.int64(1) << 31
        diagonal, of = np.unique((p << 32) + shift + half, return_inverse=True)
        q, move = diagonal >> 32, (diagonal & ((half << 1) - 1)) - half
        lo = np.maximum(move, 0)
        size = np.maximum(np.minimum(np.diff(self.xo)[q], np.diff(self.yo)[q] + move) - lo, 0)
        done, out = np.zeros(len(p), bool), []
        for a, b in W.pieces(np.concatenate(([0], np.cumsum(size))), 1 << 21):
            mine = np.flatnonzero((of >= a) & (of < b))
            found, covered = self._along(q[a:b], move[a:b], lo[a:b], size[a:b], of[mine] - a, c[mine])
            out += found
            done[mine] = covered
        left = np.flatnonzero(~done)
        if len(left):
            left = left[~self._inside(out, p[left], c[left], h[left])]
        if len(left):
            out += self._around(p[left], c[left], h[left])
        return out

    @staticmethod
    def _inside(found, p, c, h):
        """The anchors of which a passage of the same pair holds both ends, as in texts that repeat themselves."""
        out = np.zeros(len(p), bool)
        if found:
            spans = np.array(found)
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            for i in np.unique(p):
                q, a, b, ya, yb = spans[slice(*np.searchsorted(spans[:, 0], (i, i + 1)))].T
                mine = np.flatnonzero(p == i)
                for at in range(0, len(mine), 1000):
                    m = mine[at : at + 1000]
                    x, y = c[m][:, None], h[m][:, None]
                    out[m] = ((x >= a) & (x < b) & (y >= ya) & (y < yb)).any(1)
        return out

    def _along(self, q, move, lo, size, of, c):
        """Similar windows at equal places of one diagonal each; whether the anchors lie in one."""
        n, total = self.length, int(size.sum())
        base = np.concatenate(([0], np.cumsum(size)))
        which = np.repeat(np.arange(len(q)), size)
        k = np.arange(total) - base[which]
        xi = self.xo[q][which] + lo[which] + k
        yi = self.yo[q][which] + (lo - move)[which] + k
        run = np.concatenate(([0], np.cumsum(self.x[xi] == self.y[yi])))
        starts = np.flatnonzero(k + n <= size[which])
        equal = run[starts + n] - run[starts]
        good = equal >= self.need
        starts, equal = starts[good], equal[good]
        # windows with a shingle twice have smaller sets: they are compared as sets, unless equal
        odd = (equal < n) & (self._repeats(self.rx, xi[starts]) | self._repeats(self.ry, yi[starts]))
        if odd.any():
            keep = ~odd
            edge = np.concatenate(([True], (starts[1:] != starts[:-1] + 1) | (which[starts[1:]] != which[starts[:-1]])))
            run_of = np.cumsum(edge) - 1
            sure = np.bincount(run_of, keep, run_of[-1] + 1) > 0
            for i in np.flatnonzero(odd).tolist():
                if not sure[run_of[i]]:
                    s = starts[i]
                    if _similar(self.x[xi[s] : xi[s] + n], self.y[yi[s] : yi[s] + n], self.num, self.den):
                        keep[i] = sure[run_of[i]] = True
            starts = starts[keep]
        cover = np.zeros(total + n + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + n, -1)
        cover = np.cumsum(cover)[: total + 1] > 0
        out = []
        if len(starts):
            new = np.concatenate(([True], (starts[1:] > starts[:-1] + n) | (which[starts[1:]] != which[starts[:-1]])))
            first = starts[new]
            last = starts[np.concatenate((np.flatnonzero(new)[1:], [len(starts)])) - 1]
            d = which[first]
            for i, a, b, m in zip(q[d].tolist(), (k[first] + lo[d]).tolist(), (k[last] + lo[d] + n).tolist(), move[d].tolist()):
                out.append((i, a, b, a - m, b - m))
        at = c - lo[of]
        inside = (at >= 0) & (at < size[of])
        return out, inside & cover[np.where(inside, base[of] + at, total)]

    def _around(self, p, c, h, step=128):
        """Similar windows among all that hold c and h, for anchors that no diagonal covers."""
        n, out = self.length, []
        near = np.arange(-n + 1, n)

        def taken(z, zo, at, q):
            i = at[:, None] + near
            ok = (i >= 0) & (i < np.diff(zo)[q][:, None])
            return z[np.clip(i + zo[q][:, None], 0, len(z) - 1)], ok

        for lo in range(0, len(p), step):
            part = slice(lo, lo + step)
            (a, va), (b, vb) = taken(self.x, self.xo, c[part], p[part]), taken(self.y, self.yo, h[part], p[part])
            same = (a[:, :, None] == b[:, None, :]) & va[:, :, None] & vb[:, None, :]
            # most fail here: a window needs that many tokens that the other text has nearby
            run = np.zeros((len(a), 2 * n), np.int64)
            np.cumsum(same.any(2), 1, out=run[:, 1:])
            repeat = np.zeros(len(a), bool)
            for z in (a, b):
                z = np.sort(z, 1)
                repeat |= (z[:, 1:] == z[:, :-1]).any(1)
            ok = np.flatnonzero(((run[:, n:] - run[:, :n]).max(1) >= self.need) | repeat)
            if not len(ok):
                continue
            same, a, b, va, vb, which = same[ok], a[ok], b[ok], va[ok], vb[ok], ok + lo
            sums = np.zeros((len(a), 2 * n, 2 * n), np.int32)
            np.cumsum(same.cumsum(1, np.int32), 2, out=sums[:, 1:, 1:])
            both = sums[:, n:, n:] - sums[:, :n, n:] - sums[:, n:, :n] + sums[:, :n, :n]
            # a window whose ends are inside the text is inside it
            fit = (va[:, :n] & va[:, n - 1 :])[:, :, None] & (vb[:, :n] & vb[:, n - 1 :])[:, None, :]
            hit = fit & (self.den * both >= self.num * (2 * n - both))
            earlier = [self._earlier(z, v) for z, v in ((a, va), (b, vb))]
            odd = np.flatnonzero((earlier[0] >= 0).any(1) | (earlier[1] >= 0).any(1))
            if len(odd):
                hit[odd] = fit[odd] & self._sets(same[odd], *(e[odd] for e in earlier))
            for i in np.flatnonzero(hit.any((1, 2))).tolist():
                s, t = np.nonzero(hit[i])
                at, other = int(c[which[i]]) - n + 1, int(h[which[i]]) - n + 1
                out.append((int(p[which[i]]), int(s.min()) + at, int(s.max()) + at + n, int(t.min()) + other, int(t.max()) + other + n))
        return out

    @staticmethod
    def _earlier(z, valid):
        """The last place before each with the same token; -1 if none."""
        i = np.arange(z.shape[1])
        same = (z[:, :, None] == z[:, None, :]) & (i[:, None] > i[None, :]) & valid[:, :, None] & valid[:, None, :]
        return np.where(same, i[None, None, :], -1).max(2)

    def _sets(self, same, before_a, before_b):
        """Whether windows are similar as sets: tokens count where they first stand in a window."""
        n = self.length
        start, i = np.arange(n)[:, None], np.arange(2 * n - 1)[None, :]
        window = (i >= start) & (i < start + n)
        first_a, first_b = (window & (e[:, None, :] < start) for e in (before_a, before_b))
        run = np.zeros((*same.shape[:2], 2 * n), np.int32)
        np.cumsum(same, 2, out=run[:, :, 1:])
        held = (run[:, :, n:] > run[:, :, :n]).astype(np.float32)
        common = first_a.astype(np.float32) @ held
        size = first_a.sum(2)[:, :, None] + first_b.sum(2)[:, None, :]
        return (common > 0) & (self.den * common >= self.num * (size - common))


def _verify_batches(batches, shingle, length, num, den, local):
    for batch in batches:
        offsets = [W.text_buffers(batch.column(t))[1] for t in ("ta", "tb")]
        # a few texts at a time, so that what is held does not grow with the batch
        for lo, hi in W.pieces(sum(o - o[0] for o in offsets), 8 * W.CHUNK):
            part = batch.slice(lo, hi - lo)
            p, mine, theirs = _flat(part.column("anchors"), "place", "other")
            verifier = Verifier(part.column("ta"), part.column("tb"), shingle, length, num, den, local)
            found = verifier.passages(p, mine >> 2 * REACH_BITS, theirs >> 2 * REACH_BITS)
            if found:
                i, *spans = (np.array(q) for q in zip(*found))
                more = (0, shingle - 1, 0, shingle - 1)
                sizes = [(np.diff(o)[i] + shingle - 1).astype(np.int32) for o in (verifier.xo, verifier.yo)]
                columns = [part.column(n).take(pa.array(i)) for n in ("doc", "head")] + [pa.array((q + e).astype(np.int32)) for q, e in zip(spans, more)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(z) for z in sizes], ["doc", "other", "first", "end", "o_first", "o_end", "n_words", "o_n_words"])


def _agreeing_windows(batches, length, agree):
    """The windows of each text that overlap with enough others of it at some start."""
    for batch in batches:
        row, places = _flat(batch.column("open"), "place")
        _, s0, s1 = _unpacked(places, length)
        # starts of all texts on one line, a text's behind those of the one before
        size = np.zeros(batch.num_rows + 1, np.int64)
        np.maximum.at(size, row + 1, np.maximum(s0, s1) + 2)
        base = np.cumsum(size)[row]
        edge = np.zeros(int(size.sum()) + 2, np.int64)
        np.add.at(edge, base + s0, 1)
        np.add.at(edge, base + s1 + 1, -1)
        many = np.concatenate(([0], np.cumsum(np.cumsum(edge) >= agree)))
        keep = many[base + s1 + 1] > many[base + s0]
        docs = batch.column("doc").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(docs[row[keep]]), pa.array(places[keep])], ["doc", "place"])


def _near_batches(batches, shingle, length):
    """The shingles of a text that a comparison at one of its open windows can reach."""
    for batch in batches:
        x, offsets = _tokens(batch.column("text"), shingle)
        row, places = _flat(batch.column("open"), "place")
        cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
        docs, out = batch.column("doc").to_pylist(), []
        for i, doc in enumerate(docs):
            mine, own = places[cuts[i] : cuts[i + 1]], x[offsets[i] : offsets[i + 1]]
            if len(mine):
                c, edge = mine >> 2 * REACH_BITS, np.zeros(len(own) + 1, np.int64)
                np.add.at(edge, np.maximum(c - length + 1, 0), 1)
                np.add.at(edge, np.minimum(c + length, len(own)), -1)
                near = np.unique(own[np.cumsum(edge[:-1]) > 0])
                out.append((np.full(len(near), doc, np.int64), near.view(np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q)) for q in zip(*out)], ["doc", "x"])


def _texts_with(x, of, commons):
    """How many texts have each token x of the rows `of`, by the rows' list<struct<x, n>> column; 0 where it names none."""
    row, tokens, n = _flat(commons, "x", "n")
    if not len(tokens):
        return np.zeros(len(x), np.int64)
    named = lambda z, r: W.mix64(z ^ W.mix64(r.astype(U) + U(1)))
    names, mine = named(tokens.view(U), row), named(x, of)
    order = np.argsort(names)
    names = names[order]
    at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
    return np.where(names[at] == mine, n[order][at], 0)


def _among_least(order, first, limits, mark, length):
    """Whether some window has as few tokens before each place's as its limit says, for several arrays of limits.

    first: the places of each start whose token is there for the first time; None if no token repeats.
    """
    places = order.shape[1]
    kind = np.int8 if places < 127 else np.int16
    before = np.zeros((places + 1, *order.shape), kind)
    if first is None:
        # starts on the outside, so that every step runs over whole rows
        less = np.ascontiguousarray(order.T)[:, :, None] < order
        for i in range(places):
            np.add(before[i], less[i], out=before[i + 1])
        before = before[length:] - before[:-length]
    else:
        less = (order[:, None, :] < order[:, :, None]).astype(np.float32)
        before = (less @ first.transpose(0, 2, 1).astype(np.float32)).transpose(2, 0, 1).astype(kind)
    out = []
    for limit in limits:
        near = before <= limit.T.astype(kind)[:, :, None]
        hit = np.zeros(order.shape, bool)
        for start in range(length):
            hit[:, start : start + length] |= near[start, :, start : start + length]
        out.append(hit & mark)
    return out


def _possible_batches(batches, shingle, length, num, den, step=128):
    """The open windows with enough shingles that other texts have near their open windows, and the rarest of these.

    Of similar sets either shares num/den or more of its shingles, each counted where it first
    stands in a window. Therefore the least shared one, in an order that is the same for all texts,
    is among the few least of either. `rare` are those few of all windows that hold the minimum,
    ordered by the number of texts that have them, less those that no other text has. The first
    `sure` suffice if no window on either side repeats a shingle; odd: some window there does.
    """
    start, i = np.arange(length)[:, None], np.arange(2 * length - 1)[None, :]
    window = (i >= start) & (i < start + length)
    near = np.arange(-length + 1, length)
    need = -(-2 * num * length // (num + den))
    for batch in batches:
        x, offsets = _tokens(batch.column("text"), shingle)
        row, places = _flat(batch.column("open"), "place")
        n_texts = _texts_with(x, np.repeat(np.arange(batch.num_rows), np.diff(offsets)), batch.column("common"))
        order = np.where(n_texts > 0, np.minimum(n_texts, (1 << 22) - 1) << 40 | (W.mix64(x) >> U(24)).astype(np.int64), 0)
        docs, close = batch.column("doc").to_numpy(zero_copy_only=False), _near_repeats(x, offsets, 2 * length)
        for lo in range(0, len(row), step):
            r, c = row[lo : lo + step], places[lo : lo + step] >> 2 * REACH_BITS
            at = c[:, None] + near
            valid = (at >= 0) & (at < np.diff(offsets)[r][:, None])
            at = np.clip(at + offsets[r][:, None], 0, max(len(x) - 1, 0))
            fits = valid[:, :length] & valid[:, length - 1 :]
            mark = (n_texts[at] > 0) & valid
            run = np.zeros((len(r), 2 * length), np.int64)
            np.cumsum(mark, 1, out=run[:, 1:])
            size, held = np.full(fits.shape, length), run[:, length:] - run[:, :length]
            again = close[np.minimum(offsets[r] + c + length, offsets[r + 1])] > close[np.maximum(offsets[r] + c - length + 1, offsets[r])]
            first = np.zeros((len(r), *window.shape), bool)
            if again.any():
                earlier = Verifier._earlier(x[at[again]], valid[again])
                first[again] = window & (earlier[:, None, :] < start)
                size[again], held[again] = first[again].sum(2), (first[again] & mark[again][:, None, :]).sum(2)
            ok = fits & (held > 0) & (den * held >= num * size)
            odd = (fits & (size < length)).any(1)
            # where no set is smaller, similar windows have `need` in common
            wide, sure = np.zeros(at.shape, bool), np.zeros(at.shape, bool)
            for some in (np.flatnonzero(ok.any(1) & ~again), np.flatnonzero(ok.any(1) & again)):
                if len(some):
                    limits = np.where(ok, size + -num * size // den, -1)[some], np.where(ok & (held >= need), length - need, -1)[some]
                    wide[some], sure[some] = _among_least(order[at[some]], first[some] if again[some[0]] else None, limits, mark[some], length)
            wide |= sure
            keep = np.flatnonzero(wide.any(1))
            if len(keep):
                of, j = np.nonzero(wide[keep])
                tokens, late = x[at[keep[of], j]], ~sure[keep[of], j]
                by = np.lexsort((late, tokens, of))
                of, tokens, late = of[by], tokens[by], late[by]
                once = np.concatenate(([True], (of[1:] != of[:-1]) | (tokens[1:] != tokens[:-1])))
                of, tokens, late = of[once], tokens[once], late[once]
                by = np.lexsort((late, of))
                rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(keep) + 1)), pa.int32()), pa.array(tokens[by].view(np.int64)))
                n_sure = np.bincount(of, ~late, len(keep)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(docs[r[keep]]), pa.array(places[lo : lo + step][keep]), rare, pa.array(n_sure), pa.array(odd[keep])], ["doc", "place", "rare", "sure", "odd"])


def distinct_texts(docs):
    """(doc, text) of each distinct text, under its least id; and (doc_id, doc) of all rows, with n_copies."""
    digest = F.unhex(F.md5(F.col("text").cast("binary"))).alias("d")
    row = materialize(docs.select("doc_id", digest), "rows")
    own = row.groupBy("d").agg(F.min("doc_id").alias("least"), F.count_distinct("doc_id").alias("n_copies"))
    # an id under which different texts are the least ones names only one of them
    again = own.groupBy("least").agg(F.min("d").alias("first"), F.count("*").alias("n")).where("n > 1").select("least", "first")
    doc = F.when(F.col("d") != F.col("first"), F.xxhash64("d", "least")).otherwise(F.col("least")).alias("doc")
    named = own.join(small_or_not(again), "least", "left").select("d", "least", "n_copies", doc)
    members = materialize(row.distinct().join(named, "d"), "members")
    # most texts stand alone under an id of their own; only rows of ids that repeat are told apart by text
    repeated = materialize(row.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    gone = members.where("doc_id <> least").select("doc_id").distinct()
    kept = docs.join(small_or_not(gone.unionByName(repeated).distinct()), "doc_id", "left_anti").select(F.col("doc_id").alias("doc"), "text")
    if not repeated.isEmpty():
        first = members.where("doc_id = least").select("doc_id", "d", "doc").distinct()
        odd = docs.join(small_or_not(repeated), "doc_id", "left_semi").select("doc_id", "text", digest).join(first, ["doc_id", "d"])
        kept = kept.unionByName(odd.select("doc", "text").dropDuplicates(["doc"]))
    return kept, members.select("doc_id", "doc", "n_copies")


def repeated_passages(docs, min_words=50, shingle=5, num=80, den=100, functions=6, agree=2):
    """doc_id, first_word, end_word, class_id, n_links of every passage that other documents have too."""
    spark = docs.sparkSession
    ship_package(spark)
    length = min_words - shingle + 1
    if not 0 < length < 1 << REACH_BITS:
        raise ValueError(f"min_words must leave 1 to {(1 << REACH_BITS) - 1} shingles")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    units, copies = distinct_texts(docs)
    # equal texts share all of their words; texts that are one row each need no row here
    copied = units.join(small_or_not(copies.where("n_copies > 1").select("doc").distinct()), "doc", "left_semi")
    whole = copied.select("doc", F.lit(0).alias("first"), F.size(F.expr("filter(split(text, '[ \\\\x09-\\\\x0D]+'), x -> x != '')")).alias("end"))
    # chosen after it is written: a filter on the number of words would move below the joins, to all texts
    whole = materialize(whole, "copied").where(f"end >= {min_words}")

    windows = lambda d: d.mapInArrow(lambda it: _window_batches(it, shingle, length, functions), WINDOW)
    crowded = crowded_ranges(windows(units.where(f"pmod(xxhash64(doc), {SAMPLE}) = 0")))
    members = materialize(shared_members(windows(units), "doc", crowded, stream=True), "windows")

    def verified(pairs, name, local=True):
        """Passages that pairs (doc, place, head, other) of windows have in common."""
        anchors = pairs.where("doc <> head").groupBy("doc", "head").agg(F.collect_set(F.struct("place", "other")).alias("anchors"))
        anchors = anchors.where(F.size("anchors") >= agree).mapInArrow(lambda it: _agreeing_batches(it, length, agree), anchors.schema)
        anchors = materialize(anchors, "anchors")
        text = lambda c, t: units.join(small_or_not(anchors.select(F.col(c).alias("doc")).distinct()), "doc", "left_semi").select(F.col("doc").alias(c), F.col("text").alias(t))
        joined = anchors.join(text("doc", "ta"), "doc").join(text("head", "tb"), "head")
        found = materialize(joined.mapInArrow(lambda it: _verify_batches(it, shingle, length, num, den, local), LINKS), name)
        discard(anchors)
        return found

    def grouped(links):
        """Overlapping spans of a text joined into nodes, and the smallest node reachable: node (doc, first word), end, g.

        from_ and to_ take in gaps beside a node that are too short for a passage of their own: one
        that was found there would overlap the node and be joined to it.
        """
        theirs = links.select(F.col("other").alias("doc"), F.col("o_first").alias("first"), F.col("o_end").alias("end"), F.col("o_n_words").alias("n_words"))
        spans = links.select("doc", "first", "end", "n_words").unionByName(theirs).unionByName(whole.withColumn("n_words", F.col("end"))).distinct()
        order = Window.partitionBy("doc").orderBy("first", "end")
        reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        nth = F.sum(F.when(F.col("first") < F.coalesce(reach, F.lit(-1)), 0).otherwise(1)).over(order)
        own = Window.partitionBy("doc", "nth")
        spans = spans.withColumn("nth", nth).select("doc", "first", "end", "n_words", F.struct("doc", F.min("first").over(own).alias("a")).alias("node"), F.max("end").over(own).alias("b"))
        spans = materialize(spans, "nodes")
        mine = spans.select("doc", "first", "end", F.col("node").alias("u"))
        theirs = spans.select(F.col("doc").alias("other"), F.col("first").alias("o_first"), F.col("end").alias("o_end"), F.col("node").alias("v"))
        groups = components(links.join(mine, ["doc", "first", "end"]).join(theirs, ["other", "o_first", "o_end"]).select("u", "v"))
        nodes = spans.select("node", "b", "n_words").distinct().join(groups.withColumnRenamed("id", "node"), "node", "left")
        nodes = nodes.select("node", "b", "n_words", F.coalesce("component", "node").alias("g"))
        order = Window.partitionBy("node.doc").orderBy("node.a")
        before, after = F.coalesce(F.lag("b").over(order), F.lit(0)), F.lead("node.a").over(order)
        nodes = nodes.withColumns({
            "from_": F.when(F.col("node.a") - before < min_words, before).otherwise(F.col("node.a")),
            "to_": F.when(after.isNull() & (F.col("n_words") - F.col("b") < min_words), F.col("n_words")).otherwise(F.col("b")),
        })
        nodes = materialize(nodes, "groups")
        discard(spans)
        return nodes

    def spanning(members, nodes, name):
        """The windows of buckets that still hold different groups, with their group; an uncovered window is in none."""
        cover = nodes.groupBy(F.col("node.doc").alias("doc")).agg(F.collect_list(F.struct("from_", "to_", "g")).alias("cover"))
        c = f"shiftright(place, {2 * REACH_BITS})"
        inside = F.expr(f"get(filter(cover, s -> {c} >= s.from_ and {c} < s.to_), 0).g")
        g = members.join(cover, "doc", "left").select(*members.columns, F.coalesce(inside, F.struct("doc", F.lit(-1).alias("a"))).alias("g"))
        g = materialize(g, "marked")
        named = g.select("key", F.xxhash64("g.doc", "g.a").alias("n"))
        open_ = named.groupBy("key").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).where("lo <> hi").select("key")
        open_ = materialize(g.join(open_, "key"), name)
        discard(g)
        return open_

    links = verified(members.select("doc", "place", F.col("head.doc").alias("head"), F.col("head.place").alias("other")), "spans", False)
    nodes = grouped(links)

    left = spanning(members.select("key", "doc", "place"), nodes, "open")
    discard(members)
    if not left.isEmpty():
        places = F.collect_set(F.struct("place")).alias("open")
        agreed = left.groupBy("doc").agg(places).mapInArrow(lambda it: _agreeing_windows(it, length, agree), "doc long, place long")
        opens = materialize(agreed.groupBy("doc").agg(places), "agreeing")
        texts = units.join(small_or_not(opens.select("doc")), "doc", "left_semi").join(opens, "doc").select("doc", "text", "open")
        each = materialize(texts.mapInArrow(lambda it: _near_batches(it, shingle, length), "doc long, x long"), "near")
        shared = each.groupBy("x").agg(F.count("*").alias("n")).where("n > 1")
        common = each.join(shared, "x").groupBy("doc").agg(F.collect_list(F.struct("x", "n")).alias("common"))
        possible = texts.join(common, "doc").mapInArrow(lambda it: _possible_batches(it, shingle, length, num, den), "doc long, place long, rare array<long>, sure long, odd boolean")
        possible = materialize(left.join(possible, ["doc", "place"]), "possible")
        discard(opens, each, left)
        # windows of `length` different shingles each share more of them than those that repeat some
        uneven = possible.groupBy("key").agg(F.max("odd").alias("uneven")).where("uneven").select("key", "uneven")
        rare = F.expr("if(uneven, rare, slice(rare, 1, int(sure)))")
        kept = possible.join(uneven, "key", "left").select("key", F.xxhash64("g.doc", "g.a").alias("g"), "doc", "place", F.explode(rare).alias("x"))
        finer = kept.select(F.xxhash64("key", "x").alias("key"), "g", "doc", "place")
        crowded = crowded_ranges(finer.where(f"pmod(xxhash64(doc), {SAMPLE}) = 0"))
        left = materialize(shared_members(finer, "g", crowded, stream=True), "finer")
        discard(possible)
        pairs = left.where("g <> head.g").select("doc", "place", F.col("head.doc").alias("head"), F.col("head.place").alias("other"))
        links = links.unionByName(verified(pairs, "spans"))
        nodes = grouped(links)
        finer, left = left, spanning(left.select("key", "doc", "place"), nodes, "open")
        discard(finer)
        # what is left: every pair of windows of a bucket that are in different groups, once a pair
        main = left.groupBy("key", "g").count().groupBy("key").agg(F.max_by("g", F.struct("count", "g")).alias("main"))
        light = left.join(main, "key").where("g <> main").drop("main")
        rest = left.select("key", F.col("doc").alias("head"), F.col("place").alias("other"), F.col("g").alias("hg"))
        again = verified(light.join(rest, "key").where("g <> hg and doc <> head").select("doc", "place", "head", "other"), "spans")
        if not again.isEmpty():
            nodes = grouped(links.unionByName(again))

    # back to documents: one row a class, which its passages join
    rows = nodes.join(copies.select("doc_id", "doc").distinct(), F.col("node.doc") == F.col("doc"))
    sizes = rows.groupBy("g").agg(F.min("doc_id").alias("class_id"), (F.count_distinct("doc_id") - 1).alias("n_links")).where("n_links > 0")
    return rows.join(sizes, "g").select("doc_id", F.col("node.a").alias("first_word"), F.col("b").alias("end_word"), "class_id", "n_links")
