"""Edit distance (insertions, deletions, substitutions of code points): of one pair by bit-parallel columns in Python's
integers, of many pairs at once by furthest-reaching diagonals in numpy; and a lower bound of many, by bit-parallel bands."""

from __future__ import annotations

import numpy as np


def _masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def edit_distance(a: str, b: str, most: int) -> int | None:
    """The distance if it is at most `most`, else None. Common ends are cut off first."""
    if abs(len(a) - len(b)) > most:
        return None
    if a == b:
        return 0
    start, end = 0, min(len(a), len(b))
    step = 1 << 30
    while step:  # common prefix by halving
        if start + step <= end and a[start : start + step] == b[start : start + step]:
            start += step
        step >>= 1
    a, b = a[start:], b[start:]
    start, end, step = 0, min(len(a), len(b)), 1 << 30
    while step:
        if start + step <= end and a[len(a) - start - step : len(a) - start] == b[len(b) - start - step : len(b) - start]:
            start += step
        step >>= 1
    a, b = a[: len(a) - start], b[: len(b) - start]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) if len(b) <= most else None
    masks, full, top = _masks(a), (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for i, c in enumerate(b):
        x = masks.get(c, 0) | down
        diagonal = (((x & up) + up) ^ up) | x
        plus, minus = down | ~(diagonal | up), up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal & full
        if score - (len(b) - i - 1) > most:
            return None
    return score if score <= most else None


def best_infix(pattern: str, text: str) -> tuple[int, int, int]:
    """(distance, start, end) of the part of `text` nearest to `pattern`: the earliest end, then the longest such part."""
    found = text.find(pattern)
    if found >= 0:
        return 0, found, found + len(pattern)

    def scan(p: str, t: str, free: bool) -> list[int]:
        masks, full, top = _masks(p), (1 << len(p)) - 1, 1 << (len(p) - 1)
        up, down, score, out = full, 0, len(p), [len(p)]
        for c in t:
            x = masks.get(c, 0) | down
            diagonal = (((x & up) + up) ^ up) | x
            plus, minus = down | ~(diagonal | up), up & diagonal
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            plus, minus = plus << 1 | (0 if free else 1), minus << 1
            up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal & full
            out.append(score)
        return out

    if not pattern:
        return 0, 0, 0
    scores = scan(pattern, text, True)
    least = min(scores)
    end = scores.index(least)
    back = scan(pattern[::-1], text[:end][::-1], False)
    return least, end - (len(back) - 1 - back[::-1].index(least)), end


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(of each place of the joined texts, the characters from there on that fill 64 bits; starts; sizes; characters a word)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    dense, top = points, int(points.max(initial=0))
    if top >= 256:  # a number for each character that is there, if that makes them fit into a byte
        there = np.zeros(top + 1, bool)
        there[points] = True
        if np.count_nonzero(there) < 256:
            dense, top = (np.cumsum(there) - 1)[points], 255
    bits = 8 if top < 256 else 16 if top < 65536 else 32
    each = 64 // bits
    padded = np.concatenate([dense.astype(np.uint64), np.zeros(each, np.uint64)])
    words = np.zeros(len(points) + 1, np.uint64)
    for k in range(each):
        words |= padded[k : k + len(words)] << np.uint64(bits * k)
    return words, np.cumsum(sizes) - sizes, sizes, each


def within(xs: list[str], ys: list[str], most: list[int], cells: int = 1 << 17) -> np.ndarray:
    """bool of each pair: whether its distance is at most its `most`. Exact; work in parts of about `cells` diagonals."""
    n = len(xs)
    out = np.zeros(n, bool)
    limits = np.asarray(most, np.int64)
    # Those with about the same limit and the same difference in length together: they need the same diagonals.
    off = np.fromiter(map(len, ys), np.int64, n) - np.fromiter(map(len, xs), np.int64, n)
    order = np.lexsort((off, np.ceil(np.log2(limits + 1) * 4)))
    begin = 0
    while begin < n:
        end = begin + 1
        while end < n and (end - begin + 1) * (2 * int(limits[order[end]]) + 1) <= cells:
            end += 1
        part = order[begin:end]
        out[part] = _within([xs[i] for i in part], [ys[i] for i in part], limits[part])
        begin = end
    return out


def _within(xs: list[str], ys: list[str], most: np.ndarray) -> np.ndarray:
    words, starts, sizes, each = _words(xs + ys)
    bits, n = np.uint64(64 // each), len(xs)
    x0, y0, nx, ny = starts[:n], starts[n:], sizes[:n], sizes[n:]
    out = np.zeros(n, bool)
    live = np.flatnonzero(np.abs(nx - ny) <= most)
    widest = int(most[live].max()) if len(live) else 0
    # reach[p, k]: how far in x the diagonal k - widest - 1 (of y minus x) has come with e edits; -2 where none did.
    reach = np.full((len(live), 2 * widest + 3), -2, np.int64)
    for e in range(widest + 1):
        if not len(live):
            break
        # The end is on the diagonal ny - nx: one that is further from there than the edits left is of no use any more.
        left, off = int(most[live].max()) - e, ny[live] - nx[live]
        low, high = max(-e, int(off.min()) - left), min(e, int(off.max()) + left)
        if low > high:
            break
        diagonals = np.arange(low, high + 1) + widest + 1
        shift = diagonals - widest - 1
        if e == 0:
            at = np.zeros((len(live), 1), np.int64)
        else:
            old = reach[:, diagonals[0] - 1 : diagonals[-1] + 2]
            at = np.maximum(np.maximum(old[:, 1:-1] + 1, old[:, 2:] + 1), old[:, :-2])
        end = np.minimum(nx[live][:, None], ny[live][:, None] - shift)
        at = np.minimum(at, end)
        at = np.where(at < np.maximum(0, -shift), -2, at)
        flat, stop = at.ravel(), end.ravel()
        row = np.repeat(live, len(shift))
        here = np.flatnonzero((flat >= 0) & (flat < stop))
        x_base, y_base = x0[row], y0[row] + np.tile(shift, len(live))
        while len(here):
            place = flat[here]
            differ = words[x_base[here] + place] ^ words[y_base[here] + place]
            same = np.where(differ == 0, each, (np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // bits).astype(np.int64))
            flat[here] = np.minimum(place + same, stop[here])
            here = here[(same == each) & (flat[here] < stop[here])]
        reach[:, diagonals] = at = flat.reshape(at.shape)
        last = off + widest + 1
        done = (np.abs(off) <= e) & (reach[np.arange(len(live)), np.clip(last, 0, reach.shape[1] - 1)] >= nx[live])
        out[live[done]] = True
        stay = ~done & (most[live] > e)
        if not stay.all():
            live, reach = live[stay], reach[stay]
    return out


#: Characters that maybe_within() tells apart (of more, some count as equal), pairs and words of a table at once.
LETTERS, LANES, TABLE = 63, 2048, 1 << 20
#: Of pairs with a higher limit, or of fewer with like limits, it says nothing: one pair at a time is faster then.
WIDEST, FEWEST = 127, 100


def maybe_within(texts: list[str], a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """bool of each pair (places in texts): False only where the distance is certainly over `most`.

    Of at least FEWEST pairs with `most` up to WIDEST, and LETTERS characters in all texts, True means that it is within `most`.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    there, code = np.unique(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), return_inverse=True)
    code, letters = (code % LETTERS).astype(np.uint8), min(len(there), LETTERS)
    starts = np.cumsum(sizes) - sizes
    x, y = np.where(sizes[a] < sizes[b], b, a), np.where(sizes[a] < sizes[b], a, b)
    out = sizes[x] - sizes[y] <= most
    words = (2 * most + 64) // 64
    order = np.flatnonzero(out & (sizes[y] > 0) & (most <= WIDEST))
    order = order[np.lexsort((sizes[x[order]], words[order]))]
    begin = 0
    while begin < len(order):
        w, end = int(words[order[begin]]), min(begin + LANES, len(order))
        end = begin + int(np.searchsorted(words[order[begin:end]], w, side="right"))
        row = (letters + 1) * (sizes[x[order[begin:end]]] // 64 + 2 * w + 2)
        part = order[begin : max(begin + 1, begin + int(np.searchsorted(row * np.arange(1, len(row) + 1), TABLE, side="right")))]
        if len(part) >= FEWEST:
            out[part] = _band(code, starts, sizes, letters, x[part], y[part], most[part], w)
        begin += len(part)
    return out


def _band(code: np.ndarray, starts: np.ndarray, sizes: np.ndarray, letters: int, x: np.ndarray, y: np.ndarray, most: np.ndarray, words: int) -> np.ndarray:
    """Whether the distance of each x (the longer) and y is within `most`: the columns of Hyyro's band, which moves a row down
    with each column, in `words` words; its last row is the diagonal `most` below the main one, then the last row of x."""
    one, top = np.uint64(1), np.uint64(63)
    own, mine = np.unique(x, return_inverse=True)
    across = int(-(-sizes[own].max() // 64))
    row = words + across + words + 1
    # The places of each letter in each x, with empty words before and behind; the row `letters` is of no letter.
    at = np.full((len(own), across * 64), letters, np.uint8)
    flat = np.repeat(np.arange(len(own)), sizes[own])
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
    at[flat, place] = code[starts[own][flat] + place]
    table = np.zeros((len(own), letters + 1, row), np.uint64)
    at = at.reshape(len(own), across, 64)
    i, j = np.arange(len(own))[:, None], words + np.arange(across)[None, :]
    for bit in range(64):
        table[i, at[:, :, bit], j] |= one << np.uint64(bit)
    table = table.ravel()

    lane, out = np.arange(len(x)), np.zeros(len(x), bool)
    nx, ny, first, score = sizes[x], sizes[y], starts[y], most.copy()
    base, begin, end = mine * (letters + 1), most + 1, most * 2 + ny - nx
    bits = 64 * words
    low = bits - most - 1  # the first bit that is set
    plus = [np.where(low >= 64 * (w + 1), np.uint64(0), ~np.uint64(0) << np.clip(low - 64 * w, 0, 63).astype(np.uint64)) for w in range(words)]
    minus = [np.zeros(len(x), np.uint64) for _ in range(words)]
    for column in range(int(ny.max())):
        if column % 16 == 0:
            over, dead = column >= ny, score > end
            out[lane[over & (score <= most)]] = True
            keep = ~(over | dead)
            if not keep.any():
                return out
            if np.count_nonzero(keep) < 0.9 * len(keep):
                lane, nx, ny, first, score, base, begin, end, most = (v[keep] for v in (lane, nx, ny, first, score, base, begin, end, most))
                plus, minus = [v[keep] for v in plus], [v[keep] for v in minus]
        live = column < ny
        where = begin + column
        word = (base + code[first + np.minimum(column, ny - 1)]) * row + (where >> 6)
        shift = (where & 63).astype(np.uint64)
        got = [table[word + w] for w in range(words + 1)]
        zero, carry = [], None
        for w in range(words):
            match = (got[w] >> shift) | ((got[w + 1] << one) << (top - shift))
            total = (match & plus[w]) + plus[w]
            more = total < plus[w]
            if carry is not None:
                total = total + carry
                more |= total < carry
            carry = more.astype(np.uint64)
            zero.append((total ^ plus[w]) | match | minus[w])
        up = [minus[w] | ~(zero[w] | plus[w]) for w in range(words)]
        down = [zero[w] & plus[w] for w in range(words)]
        slide = column < nx - most
        step = (~zero[-1] >> top).astype(np.int64)
        if not slide.all():
            bit = np.clip(bits + nx - most - 2 - column, 0, bits - 1)
            here, pick = (bit & 63).astype(np.uint64), bit >> 6
            flat_step = np.zeros(len(bit), np.int64)
            for w in range(words):
                flat_step += np.where(pick == w, ((up[w] >> here) & one).astype(np.int64) - ((down[w] >> here) & one).astype(np.int64), 0)
            step = np.where(slide, step, flat_step)
        score = score + np.where(live, step, 0)
        for w in range(words):
            moved = zero[w] >> one
            if w + 1 < words:
                moved |= zero[w + 1] << top
            plus[w], minus[w] = down[w] | ~(moved | up[w]), moved & up[w]
    out[lane[score <= most]] = True
    return out
