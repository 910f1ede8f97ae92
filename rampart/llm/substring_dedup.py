"""Substring de-duplication over words by seed and extend.

Every window of LENGTH words holds the winnowed anchor (a gram of GRAM words)
that any other document with the same window selects at the same place, so equal windows
meet under their anchor. A member of an anchor is a (document, context) with the
context of all words that a window over the anchor can reach.

Blocks first send their anchors' hashes; only those of two documents or more go on.
The windows of crowded anchors, with many different contexts, meet under their own
hash, which Spark reduces partition by partition. Of the other anchors:

1. Members with one context are one: all but the smallest document's are repeats as
   far as the context reaches. A block sends a context once, whatever its copies.
2. The smallest documents of anchors with several contexts are extended to both
   sides: for every number of words to the left, members that agree that far left and
   the rest of a window right share a window, which is a repeat in all but the smallest.

Overlapping windows of a document merge into its maximal repeats. No pairs are
listed anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import common
from rampart.llm.common import RangeHashes, WordHashes, mix

LENGTH = 50
GRAM = 10
BLOCK_BYTES = 2 << 20  # of text in a block: the arrays of its words take some fifty times that

MEMBER = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("doc", "<i8")])
REPEAT, EXTEND = 1, 2  # answers to a member


class Seeds:
    """A block's anchors, contexts and members."""

    def __init__(self, row: dict, hashes: WordHashes, length: int, gram: int, shard_count: int):
        self.ids, _, texts = common.unpack(row)
        self.texts_hash = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64).tolist()
        self.words = [t.split() for t in texts]
        self.starts = np.cumsum([0, *map(len, self.words)])
        self.length, self.gram = length, gram
        self.units = hashes.of([w for ws in self.words for w in ws])
        ranges = RangeHashes(self.units)
        n, reach = len(self.units), length - gram
        first = np.arange(max(0, n - gram + 1))
        grams = ranges.of(first, first + gram)
        self.place, self.string = common.selected((grams >> np.uint64(32)).astype(np.uint32), self.starts, reach + 1, length)
        self.at = at = np.unique(self.place)
        self.ranges = ranges
        self.doc = np.searchsorted(self.starts, at, side="right") - 1
        self.left = np.minimum(at - self.starts[self.doc], reach)
        self.right = np.minimum(self.starts[self.doc + 1] - at - gram, reach)
        self.anchor = grams[at]
        edges = (self.left * (reach + 1) + self.right).astype(np.uint64)
        self.context = mix(ranges.of(at - self.left, at + gram + self.right) ^ mix(edges + np.uint64(1)) ^ self.anchor)
        # each different anchor once
        self.hashes, self.number = np.unique(self.anchor, return_inverse=True)
        self.shard_count = shard_count
        self.anchor_shard = self._shard(self.hashes)

    def _shard(self, anchor: np.ndarray) -> np.ndarray:
        return (anchor >> np.uint64(20)).astype(np.int64) % self.shard_count

    def anchors(self) -> np.ndarray:
        """Each different anchor, with the number of its different contexts."""
        owner = self.ids[self.doc]
        low, high = np.full(len(self.hashes), common.NO_ID), np.full(len(self.hashes), -2**63, np.int64)
        np.minimum.at(low, self.number, owner)
        np.maximum.at(high, self.number, owner)
        _, first = np.unique(self.context, return_index=True)
        many = np.bincount(self.number[first], minlength=len(self.hashes))
        return common.anchor_entries(self.hashes.astype(np.uint32), low < high, many)

    def choose(self, answer: np.ndarray) -> None:
        """Set the members: of the shared anchors each context once, with its smallest
        document's first place; and which anchors are crowded."""
        answer = answer[self.number]
        self.crowded = answer == common.CROWDED
        at = np.flatnonzero(answer == common.SHARED)
        owner = self.ids[self.doc]
        order = at[np.lexsort((self.at[at], owner[at], self.context[at]))]
        head = np.r_[True, self.context[order][1:] != self.context[order][:-1]][: len(order)]
        self.member = np.full(len(self.at), -1)  # none
        self.member[order] = np.cumsum(head) - 1
        self.chosen = order[head]
        self.entries = np.zeros(len(self.chosen), MEMBER)
        self.entries["anchor"], self.entries["context"], self.entries["doc"] = self.anchor[self.chosen], self.context[self.chosen], owner[self.chosen]
        self.shard = self._shard(self.entries["anchor"])

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, anchor, hash, document) of each window of a crowded anchor."""
        at = np.searchsorted(self.at, self.place)
        hot = np.flatnonzero(self.crowded[at])
        at, start = at[hot], self.string[hot]
        return start, self.anchor[at], self.ranges.of(start, start + self.length), self.ids[self.doc[at]]


def judge_members(entries: np.ndarray) -> np.ndarray:
    """REPEAT: a smaller document has this context. EXTEND: it is the smallest
    one's, and the anchor has other contexts."""
    order = np.lexsort((entries["doc"], entries["context"]))
    context, doc = entries["context"][order], entries["doc"][order]
    head = np.r_[True, context[1:] != context[:-1]][: len(order)]
    least = doc[head][np.cumsum(head) - 1]
    anchors, inverse = np.unique(entries["anchor"][order], return_inverse=True)
    many = np.bincount(inverse, head, len(anchors))[inverse] > 1
    out = np.zeros(len(entries), np.uint8)
    out[order] = np.where(least < doc, REPEAT, np.where(many, EXTEND, 0))
    return out


def extension_dtype(length: int, gram: int) -> np.dtype:
    return np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("left", "u1"), ("right", "u1"), ("words", "<u4", 2 * length - gram)])


def extend(length: int, gram: int):
    reach = length - gram

    def judge(entries: np.ndarray) -> np.ndarray:
        """For each member, one flag for each number of words to the anchor's left:
        the window from there is one of a smaller document's too."""
        out = np.zeros((len(entries), reach + 1), np.uint8)
        powers = np.multiply.accumulate(np.full(length, common.BASE, np.uint64))
        words = mix(entries["words"].astype(np.uint64) + np.uint64(1))
        for left in range(reach + 1):
            ok = np.flatnonzero((entries["left"] >= left) & (entries["right"] >= reach - left))
            window = (words[ok, reach - left:reach - left + length] * powers).sum(1, dtype=np.uint64)
            key, doc = mix(mix(window) ^ entries["anchor"][ok]), entries["doc"][ok]
            order = np.lexsort((doc, key))
            k, d = key[order], doc[order]
            head = np.r_[True, k[1:] != k[:-1]][: len(k)]
            out[ok[order], left] = d[head][np.cumsum(head) - 1] < d
        return out

    return judge


def repeated_words(seeds: Seeds, verdict: np.ndarray, flags: np.ndarray, found: list[dict] | None) -> np.ndarray:
    """Which words of the block are in a window of a smaller document."""
    gram = seeds.gram
    delta = np.zeros(len(seeds.units) + 1, np.int64)
    if found:
        start, *crowded = seeds.windows()
        start = start[common.repeated_strings(*crowded, found)]
        np.add.at(delta, start, 1)
        np.add.at(delta, start + seeds.length, -1)
    members = np.flatnonzero(seeds.member >= 0)
    of = seeds.member[members]
    repeat = (verdict[of] == REPEAT) | (seeds.ids[seeds.doc[members]] > seeds.entries["doc"][of])
    whole = members[repeat]
    np.add.at(delta, seeds.at[whole] - seeds.left[whole], 1)
    np.add.at(delta, seeds.at[whole] + gram + seeds.right[whole], -1)
    extended = np.flatnonzero(verdict == EXTEND)
    place = np.full(len(verdict), -1)
    place[extended] = np.arange(len(extended))
    rest = members[~repeat & (place[of] >= 0)]
    hit, left = np.nonzero(flags[place[seeds.member[rest]]])
    np.add.at(delta, seeds.at[rest[hit]] - left, 1)
    np.add.at(delta, seeds.at[rest[hit]] - left + seeds.length, -1)
    return np.cumsum(delta[:-1]) > 0


def remove_repeats(df: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   hot: int = common.HOT, carry: list[str] = (), whole: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, spans, text and text_hash for every row: the text's
    words without those in a window of ``length`` words that also starts in a document
    of a smaller id; spans are the maximal removed runs (first, last word), and
    text_hash is xxhash64 of the text as it was, to join rows of repeated ids. Columns named in
    ``carry`` follow as c0, c1, ...: a row and its result need no join. With ``whole`` a text that loses
    no word stays as it was, a null one too.

    Words are what ASCII white space separates, kept ones are joined by one space.
    A null or empty text has none; a null id counts as larger than all; rows
    of equal ids remove nothing from each other; a shorter text than ``length``
    keeps all; an empty table gives an empty one; more columns are not read."""
    if not 0 < gram < length or length - gram > 255:
        raise ValueError("0 < gram < length <= gram + 255")
    many = common.shards(df.sparkSession)
    blocks = common.to_blocks(df, id_col, text_col, flag=F.col(text_col).isNull(), block_bytes=BLOCK_BYTES, carry=carry)
    member_rows = extension_dtype(length, gram)
    reach = length - gram

    def seeds(row: dict, hashes: WordHashes) -> Seeds:
        s = Seeds(row, hashes, length, gram, many)
        s.choose(common.scatter(s.anchor_shard, row["anchors"], np.uint8))
        return s

    def ask_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for row in common.rows_of(batches):
            s = Seeds(row, hashes, length, gram, many)
            yield common.asks(row["block"], s.anchor_shard, s.anchors())

    def ask_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for row in common.rows_of(batches):
            yield common.string_rows(row["block"], *seeds(row, hashes).windows()[1:])

    def ask_members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for row in common.rows_of(batches):
            s = seeds(row, hashes)
            yield common.asks(row["block"], s.shard, s.entries)

    def ask_extensions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for row in common.rows_of(batches):
            s = seeds(row, hashes)
            wanted = np.flatnonzero(common.scatter(s.shard, row["members"], np.uint8) == EXTEND)
            at = s.chosen[wanted]
            out = np.zeros(len(at), member_rows)
            out["anchor"], out["doc"], out["left"], out["right"] = s.anchor[at], s.ids[s.doc[at]], s.left[at], s.right[at]
            offset = np.arange(-reach, length)
            inside = (offset >= -s.left[at][:, None]) & (offset < gram + s.right[at][:, None])
            units = (s.units >> np.uint64(16)).astype(np.uint32)
            if len(at):
                out["words"] = np.where(inside, units[np.clip(s.at[at][:, None] + offset, 0, len(units) - 1)], 0)
            yield common.asks(row["block"], s.shard[wanted], out)

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for row in common.rows_of(batches):
            s = seeds(row, hashes)
            verdict = common.scatter(s.shard, row["members"], np.uint8)
            wanted = np.flatnonzero(verdict == EXTEND)
            flags = common.scatter(s.shard[wanted], row["extensions"], np.dtype(("u1", reach + 1)))
            gone = repeated_words(s, verdict, flags.reshape(len(wanted), reach + 1), row.get("strings"))
            out: list[list] = [[], [], [], [], [], []]
            _, missing, raw = common.unpack(row) if whole else (None, None, None)
            for k, words in enumerate(s.words):
                drop = gone[s.starts[k]:s.starts[k + 1]]
                edge = np.flatnonzero(np.diff(np.r_[False, drop, False].astype(np.int8)))
                if len(edge):
                    kept = [w for w, x in zip(words, drop.tolist()) if not x]
                else:
                    kept = words
                out[0].append(common.out_id(s.ids[k]))
                out[1].append(len(words))
                out[2].append(int(drop.sum()))
                out[3].append([{"first": a, "last": b - 1} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())])
                if whole and not len(edge):
                    out[4].append(None if missing[k] else raw[k].decode())
                else:
                    out[4].append(b" ".join(kept).decode())
                out[5].append(s.texts_hash[k])
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.string(), pa.int64()]
            names = ["doc_id", "n_words", "n_removed", "spans", "text", "text_hash"]
            rest = common.carried(row).combine_chunks() if carry else None
            kept_too = [c.combine_chunks() for c in rest.columns] if carry else []
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(out, types)), *kept_too], names=names + [f"c{k}" for k in range(len(carry))])

    anchors = common.materialize(common.answered(blocks.mapInArrow(ask_anchors, common.ASK_SCHEMA), common.ANCHOR, common.judge_anchors(hot)), "anchors")
    told = common.with_answers(blocks, anchors=anchors)
    members = common.materialize(common.answered(told.mapInArrow(ask_members, common.ASK_SCHEMA), MEMBER, judge_members), "members")
    asked = common.with_answers(told, members=members).mapInArrow(ask_extensions, common.ASK_SCHEMA)
    extensions = common.materialize(common.answered(asked, member_rows, extend(length, gram)), "extensions")
    if common.any_crowded(anchors):
        told = common.with_strings(told, ask_windows)
    return common.with_answers(told, members=members, extensions=extensions).mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, spans array<struct<first:int,last:int>>, text string, text_hash long"
        + "".join(f", c{k} {df.schema[c].dataType.simpleString()}" for k, c in enumerate(carry)))
