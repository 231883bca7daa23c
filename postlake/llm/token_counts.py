"""Token counts that follow edits: a segment tree over pre-token leaves for each document.

A text is cut into leaves of about ``LEAF_CHARS`` at places where a single space stands between two characters that
aren't space. The pre-token pattern always splits there, whatever stands around, so the tokens of the leaves are those
of the whole text. Leaves and their counts are stored beside the text as two heap-ordered arrays of sums (characters
and tokens). An edit descends the tree to the leaves that it touches, re-encodes only their new text (with a
neighbouring leaf where the edit spoilt the cut between them) and updates the sums above. Text that replaces several
leaves goes to the first of them, the others become empty.

Edits of a document are an array column of (start, remove, insert) in code points, applied in order, each to the text
that the ones before left; a start or length beyond the text ends at its end.

Defined results: null and empty texts have no leaves and no tokens; a null edit list, start or length means no edit, a
null insertion inserts nothing. Repeated rows and null ids keep their rows, as rows are never joined. An empty table
gives no rows. Other columns are kept by ``with_trees`` and ignored by the query.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlake.llm.tables import staged, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text for the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS = 256

_CUT = re.compile(r"(?<=\S) (?=\S)")


@cache
def encoding(ranks: str):
    """The tokenizer of a rank file, once for each worker."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table_ = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table_, special_tokens={})


def count_tokens(text: str, ranks: str) -> int:
    return len(encoding(ranks).encode_ordinary(text)) if text else 0


def leaves(text: str) -> list[str]:
    out, at = [], 0
    while at < len(text):
        cut = _CUT.search(text, at + LEAF_CHARS)
        end = cut.start() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out


class SegmentTree:
    """Heap-ordered sums: entry 1 is the total, entries ``width`` onwards are the leaves."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def of(cls, chars: list[int], tokens: list[int]) -> SegmentTree:
        width = 1 << max(0, (len(chars) - 1).bit_length())
        sums = []
        for values in (chars, tokens):
            heap = [0] * width + values + [0] * (width - len(values))
            for i in range(width - 1, 0, -1):
                heap[i] = heap[2 * i] + heap[2 * i + 1]
            sums.append(heap)
        return cls(*sums)

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's first position; the end belongs to the last filled leaf."""
        i, low = 1, 0
        position = max(0, min(position, self.chars[1] - 1))
        while i < self.width:
            i *= 2
            if position >= low + self.chars[i] and self.chars[i + 1]:
                low += self.chars[i]
                i += 1
        return i - self.width, low

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.width
        more, extra = chars - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += more
            self.tokens[i] += extra
            i //= 2

    def edit(self, text: str, start: int, remove: int, insert: str, ranks: str) -> tuple[str, int]:
        """The new text and how many characters were encoded anew; the sums follow."""
        start = max(0, min(start, len(text)))
        stop = min(len(text), start + max(0, remove))
        new = text[:start] + insert + text[stop:]
        if new == text:
            return text, 0
        first, low = self.leaf_at(start)
        last, at = self.leaf_at(max(start, stop - 1))
        high = at + self.chars[last + self.width]
        grown = len(new) - len(text)
        while low > 0 and not _CUT.match(new, low):  # the cut before is spoilt
            first, low = self.leaf_at(low - 1)
        while high < len(text) and not _CUT.match(new, high + grown):
            last, at = self.leaf_at(high)
            high = at + self.chars[last + self.width]
        changed = new[low : high + grown]
        for leaf in range(first + 1, last + 1):
            if self.chars[leaf + self.width]:
                self.set(leaf, 0, 0)
        self.set(first, len(changed), count_tokens(changed, ranks))
        return new, len(changed)


def with_trees(docs: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``docs`` with ``tree_chars`` and ``tree_tokens``."""
    names = docs.columns
    at = names.index(text)

    def build(batches):
        for batch in batches:
            trees = []
            for value in batch.column(at).to_pylist():
                parts = leaves(value or "")
                trees.append(SegmentTree.of([len(p) for p in parts], [count_tokens(p, ranks) for p in parts]))
            sums = [pa.array([t.chars for t in trees], pa.list_(pa.int32())), pa.array([t.tokens for t in trees], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], [*names, "tree_chars", "tree_tokens"])

    trees = StructType.fromDDL("tree_chars array<int>, tree_tokens array<int>")
    return docs.mapInArrow(build, StructType([*docs.schema.fields, *trees.fields]))


_EDITED = "n_tokens long, n_edits long, n_tokens_edited long, n_chars_edited long, n_chars_encoded long, new_text string"


def edited(trees: DataFrame, edits: str, keep: list[str], text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Counts before and after the edits of each row, the characters encoded for it, and the new text."""
    feed = trees.select(*keep, F.col(text).alias("_text"), "tree_chars", "tree_tokens", F.col(edits).alias("_edits"))
    fields = [f.split()[0] for f in _EDITED.split(", ")]
    k = len(keep)

    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(k + i).to_pylist() for i in range(4)]
            for value, chars, tokens, changes in zip(*columns):
                tree, now, done, encoded = SegmentTree(chars, tokens), value or "", 0, 0
                before = tree.tokens[1]
                for change in changes or []:
                    if change is None or change["start"] is None or change["remove"] is None:
                        continue
                    now, n = tree.edit(now, change["start"], change["remove"], change["insert"] or "", ranks)
                    done, encoded = done + 1, encoded + n
                out.append((before, done, tree.tokens[1], tree.chars[1], encoded, now))
            types = [pa.int64()] * 5 + [pa.string()]
            made = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *made], [*keep, *fields])

    return feed.mapInArrow(run, StructType([*feed.schema.fields[:k], *StructType.fromDDL(_EDITED).fields]))


def revision(key: str, text: str) -> F.Column:
    """Three edits of a row, placed by a hash: a deletion, a replacement, an insertion of words of the text itself."""
    size = F.length(text)

    def place(k: int) -> F.Column:
        return F.pmod(F.xxhash64(F.col(key), F.lit(k)), size + 1).cast("int")

    def edit(k: int, remove: int, insert: F.Column) -> F.Column:
        return F.struct(place(k).alias("start"), F.lit(remove).alias("remove"), insert.alias("insert"))

    words = F.substring(text, 1, 24)
    return F.array(edit(1, 40, F.lit("")), edit(2, 7, words), edit(3, 0, F.concat(F.lit(" "), words)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: tokens before and after a revision, and how many characters it took to know."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = staged(with_trees(docs), "trees")
    out = edited(trees.withColumn("edits", revision("doc_id", "text")), "edits", ["doc_id"])
    return out.drop("new_text")
