"""Token counts by rank-synchronous array merging.

Counts the tokens of a sentencepiece BPE model without building the tokens.  No piece of such a
model holds a space mark behind another character (checked when the model is read), so no merge
crosses the start of a run of space marks: the runs with what follows them are pre-tokens that
merge on their own.  A batch of distinct pre-tokens is held as one ragged array of symbol ids; in
each round every pre-token applies its lowest-rank pair, all pre-tokens at once, until none has a
pair left, and the surviving symbols are counted.  Where a merge at a rank could create a pair of
the same or a lower rank, only the leftmost occurrence is applied in that round, as a sequential
merge would; otherwise all its occurrences are.  A long word of that kind (a run of thousands of spaces) would
take as many rounds, so it leaves the arrays and its pairs are merged through a queue.

Characters that are no piece cost one byte token per UTF-8 byte when the model has byte pieces,
else one unknown token for each run of them.

Defined results: a null text counts as empty (0 bytes, 0 tokens); rows are independent, so ties,
repeated rows and null ids pass through; an empty table gives an empty table; only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

MARK = "▁"
NONE = np.int64(1 << 40)       # rank of "no such pair"
#: Pre-tokens a worker's cache holds before it starts anew, and merged together in one array.
CACHE_ENTRIES, ARRAY_SYMBOLS = 600_000, 400_000
#: Symbols from which on a word that could only merge one pair a round is merged by a queue.
QUEUED = 256
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


class Model:
    """Symbols, ranked pairs and the cost of an unmerged symbol, read from a model file."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        if sp.encode(MARK + "a", out_type=str) != sp.encode(" a", out_type=str) or sp.encode("  ", out_type=str) == []:
            raise ValueError(f"{path}: only models that keep white space and map it to {MARK} are counted here")
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError(f"{path}: a piece holds {MARK} behind another character, pre-tokens would not be independent")
        self.bytes = any(sp.is_byte(i) for i in range(size))
        self.ids: dict[str, int] = {}
        for p in pieces:
            self.ids.setdefault(p, len(self.ids))
        self.known = len(self.ids)
        # The order of merges is by falling score; equal scores share a rank.
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        left, right, rank, out = [], [], [], []
        for p, score in pieces.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(order[score]), out.append(self.ids[p])
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        by = np.argsort(key)
        self.key, self.rank, self.out = key[by], np.array(rank, np.int64)[by], np.array(out, np.int64)[by]

    def symbols(self, word: str) -> tuple[list[int], int]:
        """Ids of the characters of a pre-token that are pieces, -1 for each that is none, and the
        token cost of those."""
        ids, cost = [], 0
        for ch in word:
            i = self.ids.get(ch, -1)
            ids.append(i)
            if i < 0 and self.bytes:
                cost += len(ch.encode()) - 1    # the symbol itself is counted as one survivor
        return ids, cost

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair, NONE where there is no such merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        if not len(self.key):
            return np.full(len(key), NONE), np.zeros(len(key), np.int64)
        hit = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NONE), self.out[at]

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token; all of them are merged in step, one rank per word and round."""
        syms, extra = zip(*map(self.symbols, words), strict=True)
        lens = np.array([len(s) for s in syms], np.int64)
        total = np.array(extra, np.int64)
        sym = np.fromiter((i for s in syms for i in s), np.int64, int(lens.sum()))
        if not self.bytes and len(sym):                          # a run of unknowns is one token
            owner = np.repeat(np.arange(len(words)), lens)
            drop = np.zeros(len(sym), bool)
            drop[1:] = (sym[1:] < 0) & (sym[:-1] < 0) & (owner[1:] == owner[:-1])
            lens = lens - np.bincount(owner[drop], minlength=len(words))
            sym = sym[~drop]
        word = np.repeat(np.arange(len(words)), lens)
        rank = np.full(len(sym), NONE)
        made = np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], made[:-1] = self.pairs(sym[:-1], sym[1:])
            rank[:-1][word[:-1] != word[1:]] = NONE
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            best = np.minimum.reduceat(rank, starts)
            over = best == NONE                                  # words with nothing left to merge
            if over.any():
                total[word[starts[over]]] += sizes[over]
                stay = np.repeat(~over, sizes)
                sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
                continue
            sym, word, rank, made = self._round(sym, word, rank, made, np.repeat(best, sizes), total)
        return total.tolist()

    def _queued(self, sym: list[int]) -> int:
        """Symbols that are left of one word, merged one pair after the other: the lowest rank first, then the
        leftmost.  Pairs of equal rank that a merge makes anew queue up with the rest."""
        merges = self.by_pair
        n = len(sym)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), n
        queue = [(m[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (m := merges.get((sym[i], sym[i + 1])))]
        heapify(queue)
        while queue:
            _, i, a, b = heappop(queue)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                                         # one of the two has been merged since
            sym[i], sym[j] = merges[a, b][1], -2
            alive -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((sym[i], sym[k])):
                    heappush(queue, (m[0], i, sym[i], sym[k]))
            h = before[i]
            if h >= 0 and (m := merges.get((sym[h], sym[i]))):
                heappush(queue, (m[0], h, sym[h], sym[i]))
        return alive

    @cached_property
    def by_pair(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {(k >> 32, k & 0xFFFFFFFF): (r, o) for k, r, o in zip(self.key.tolist(), self.rank.tolist(), self.out.tolist())}

    def _round(self, sym, word, rank, made, best, total):
        at = np.flatnonzero(rank == best)
        # Of overlapping pairs (a run such as "aaa") every second one merges, from the left.
        new_run = np.r_[True, np.diff(at) != 1]
        run_start = at[new_run][np.cumsum(new_run) - 1]
        at = at[(at - run_start) % 2 == 0]
        # Pairs that exist in between when merging one after the other: with what stands left at
        # that time, and with the symbol to the right that is not merged yet.
        n = len(sym)
        merged = made[at]
        risky = np.zeros(len(at), bool)
        has_right = (at + 2 < n) & (word[np.minimum(at + 2, n - 1)] == word[at])
        r, _ = self.pairs(merged[has_right], sym[at[has_right] + 2])
        risky[has_right] |= r <= best[at[has_right]]
        has_left = (at > 0) & (word[np.maximum(at - 1, 0)] == word[at])
        left = sym[np.maximum(at - 1, 0)].copy()
        chained = np.r_[False, at[1:] - at[:-1] == 2] if len(at) else np.zeros(0, bool)
        left[chained] = merged[np.flatnonzero(chained) - 1]
        r, _ = self.pairs(left[has_left], merged[has_left])
        risky[has_left] |= r <= best[at[has_left]]
        if risky.any():
            wary = np.unique(word[at[risky]])
            # One merge a round is too slow for a long word: it leaves the arrays for a queue of its own.
            long = wary[np.searchsorted(word, wary, side="right") - np.searchsorted(word, wary) > QUEUED]
            if long.size:
                for w in long:
                    total[w] += self._queued(sym[np.searchsorted(word, w):np.searchsorted(word, w, side="right")].tolist())
                stay = ~np.isin(word, long)
                return sym[stay], word[stay], rank[stay], made[stay]
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            keep = first | ~np.isin(word[at], wary)
            at, merged = at[keep], merged[keep]
        gone = np.zeros(n, bool)
        gone[at + 1] = True
        touched = np.zeros(n, bool)
        touched[at] = True
        sym[at] = merged
        stay = ~gone
        sym, word, rank, made, touched = sym[stay], word[stay], rank[stay], made[stay], touched[stay]
        redo = touched.copy()
        redo[:-1] |= touched[1:]
        i = np.flatnonzero(redo)
        inside = i[(i + 1 < len(sym))]
        inside = inside[word[inside] == word[inside + 1]]
        rank[i] = NONE
        rank[inside], made[inside] = self.pairs(sym[inside], sym[inside + 1])
        return sym, word, rank, made


class Counter:
    """Counts whole texts; distinct pre-tokens are merged once and kept in a bounded cache."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    @staticmethod
    def pretokens(text: str) -> list[str]:
        """Pre-tokens of a non-empty text.  A word behind a single space is given without its mark."""
        text = text.replace(MARK, " ")
        words = text.split(" ")
        if "" in words:
            return [w if w[1:2] == MARK or w == MARK else w[1:] for w in _RUNS.findall(MARK + text.replace(" ", MARK))]
        return words

    def counts(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        lists, size = [], 0
        for i, t in enumerate(texts):
            lists.append(self.pretokens(t) if t else [])
            size += len(t)
            if size >= 8_000_000 or i == len(texts) - 1:
                new = set().union(*lists)
                if len(self.known) + len(new) > CACHE_ENTRIES:
                    self.known.clear()
                new.difference_update(self.known)
                self._learn(new)
                get = self.known.__getitem__
                out.extend(sum(map(get, words)) for words in lists)
                lists, size = [], 0
        return out

    def _learn(self, words: set[str]) -> None:
        """A key that does not start with the mark stands for the mark and itself."""
        todo, size = [], 0
        for w in [*words, None]:
            if w is not None:
                todo.append(w)
                size += len(w) + 1
            if todo and (w is None or size >= ARRAY_SYMBOLS):
                full = [x if x[:1] == MARK else MARK + x for x in todo]
                self.known.update(zip(todo, self.model.count(full), strict=True))
                todo, size = [], 0


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(Model(path))


def token_counts(df: DataFrame, path: str, *, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of each row of ``df``."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                     F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            n = c.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
