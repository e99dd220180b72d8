"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes of a text.

Every byte of a text gets a label: no token ends here, one of A does, one of B does, or both. A regular
expression scans the string of labels for spans up to each both-label; how many labels of either kind a
span holds says how many tokens of A and of B form its group. The last token of A and of B in a span
end together: they are linked. Over the whole corpus links count how often two ids end together.

Both tokenizers begin a new token at a space that stands between two other characters, so a text is cut
at such spaces and each distinct cut that a worker remembers is labelled once; groups never go across
a cut, since both tokenizers end a token there. (The vocabulary of B is looked at: no piece of it may
hold a space behind another character.)

Texts are gone through once; what is kept of them are their sums, and their links as numbers into the
list of distinct pairs of their chunk of documents. Those lists are a table (chunk, place, pair, n) whose
counts are added up by pair, compared within each id of B, and sent back to the chunks, as rows; all
of that is in proportion to the texts, and a pair that every chunk holds is a row of each.

Defined results: texts that are null or empty, or whose tokens of A or B do not spell a space and the text
(a text that holds the letter U+2581, say), have no tokens, so all their numbers are 0 and the digest is
empty; they add to no count. Rows with null or repeated ids are documents of their own; other columns are not
read; an empty table gives none.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellstrand.llm.chunkstore import by, number_of, put_table, read
from cellstrand.llm.common import id_and_text, slices, stored, texts_of
from cellstrand.llm.token_counts import byte_of_letter
from cellstrand.session import shared_dir
from cellstrand.sources.files import file_system

#: Where both tokenizers begin a new token.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Labels of bytes, and spans of labels up to one where tokens of both end.
NONE, A_ENDS, B_ENDS, BOTH = b".ab="
SPAN = re.compile(rb"[^=]*=")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: Distinct cuts that a worker remembers of late, and as many of before.
REMEMBERED = 250_000
#: Characters of the longest cut that is remembered beyond the texts that it came with; a text without spaces is one cut.
LONGEST = 64
#: Cuts whose labels are one string.
CUTS_AT_ONCE = 8192
#: Bytes of text of a chunk of documents, about.
CHUNK_BYTES = 8 << 20
#: A pair of ids as one number.
B_BITS = 24


class Aligner:
    """Tokens of both tokenizers and their common groups, for cuts of texts."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_of_letter()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, k in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        for piece in pieces:
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"the piece {piece!r} holds a space behind another character: texts can't be cut")
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in known], dtype=np.int64) for known in (self.a_bytes, self.b_bytes))

    def tokens(self, cuts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and of B of a space and each text."""
        a = self.a.encode_batch_fast([" " + c for c in cuts], add_special_tokens=False)
        return ((e.ids, ids) for e, ids in zip(a, self.b.encode(cuts, num_threads=1), strict=True))

    def scanned(self, cuts: list[str]) -> Scan:
        """Groups of all cuts, each with a space before it; their labels are one string, scanned at once."""
        tokens = list(self.tokens(cuts))
        texts = [b" " + c.encode() for c in cuts]
        size = np.array([len(t) for t in texts], dtype=np.int64)
        flat, spelt = [], np.ones(len(cuts), dtype=bool)
        for side, (known, sizes) in enumerate(((self.a_bytes, self.a_size), (self.b_bytes, self.b_size))):
            ids = np.fromiter(chain.from_iterable(t[side] for t in tokens), dtype=np.int64)
            owner = np.repeat(np.arange(len(cuts)), [len(t[side]) for t in tokens])
            flat.append((ids, owner))
            spelt &= np.bincount(owner, weights=sizes[ids], minlength=len(cuts)) == size
        byte_owner = np.repeat(np.arange(len(cuts)), size)
        whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
        for (ids, owner), known in zip(flat, (self.a_bytes, self.b_bytes), strict=True):
            own = np.frombuffer(b"".join([known[k] for k in ids[spelt[owner]].tolist()]), dtype=np.uint8)
            there = spelt[byte_owner]
            spelt = spelt.copy()
            spelt[byte_owner[there][own != whole[there]]] = False
        (a, a_owner), (b, b_owner) = ((ids[spelt[owner]], owner[spelt[owner]]) for ids, owner in flat)
        labels = np.full(int(size[spelt].sum()), NONE, dtype=np.uint8)
        labels[np.cumsum(self.a_size[a]) - 1] = A_ENDS
        b_end = np.cumsum(self.b_size[b]) - 1
        labels[b_end] = np.where(labels[b_end] == NONE, B_ENDS, BOTH)
        end = np.cumsum(np.array(list(map(len, SPAN.findall(labels.tobytes()))), dtype=np.int64))
        both = labels == BOTH
        upto_a, upto_b = (np.cumsum((labels == one) | both)[end - 1] for one in (A_ENDS, B_ENDS))
        begun = np.cumsum(np.where(spelt, size, 0)) - size
        of_cut = byte_owner[spelt[byte_owner]][end - 1]
        return Scan(spelt, a, b, upto_a, upto_b, of_cut, end - begun[of_cut])

    def groups(self, text: str) -> list[tuple[list[int], list[int], int]] | None:
        """(ids of A, ids of B, end of the bytes that they cover) of a whole text with a space before it."""
        if not text:
            return []
        scan = self.scanned([text])
        if not scan.spelt[0]:
            return None
        a, b = scan.a.tolist(), scan.b.tolist()
        ends = list(zip(scan.upto_a.tolist(), scan.upto_b.tolist(), scan.end.tolist(), strict=True))
        return [(a[i:p], b[j:q], end) for (i, j, _), (p, q, end) in zip([(0, 0, 0), *ends], ends, strict=False)]


@dataclass
class Scan:
    """Groups of many cuts, in order: whether each cut is spelt by its tokens, the ids of those that are, and of each group
    how many ids there are up to its end, the cut that it is of, and the bytes of the cut up to its end."""

    spelt: np.ndarray
    a: np.ndarray
    b: np.ndarray
    upto_a: np.ndarray
    upto_b: np.ndarray
    cut: np.ndarray
    end: np.ndarray


class Memory:
    """What each distinct cut of the texts has: tokens of A, of B, groups, written groups, linked pairs; None if it can't be spelt."""

    def __init__(self, aligner: Aligner, limit: int = REMEMBERED):
        self.aligner, self.limit = aligner, limit
        self.known: dict[str, tuple[int, int, int, str, bytes] | None] = {}
        self.before = self.known
        self.passing: list[str] = []
        self.a_text, self.b_text = (list(map(str, range(len(x)))) for x in (aligner.a_bytes, aligner.b_bytes))
        self.a_alone = [f"{x}|" for x in self.a_text]

    def rows(self, texts: list[str]) -> list[list[str]]:
        """Cuts of each text; all are known afterwards."""
        rows = [CUT.split(t) if t else [] for t in texts]
        wanted = set().union(*rows)
        for cut in self.passing:
            self.known.pop(cut, None)
        # cuts that were asked for since the last time that it was full are kept
        if len(self.known) + len(wanted) > self.limit:
            self.before, self.known = self.known, {}
        new = []
        for cut in wanted:
            if cut not in self.known:
                if cut in self.before:
                    self.known[cut] = self.before[cut]
                else:
                    new.append(cut)
        self.passing = [c for c in new if len(c) > LONGEST]
        for k in range(0, len(new), CUTS_AT_ONCE):
            self._learn(new[k : k + CUTS_AT_ONCE])
        return rows

    def _learn(self, cuts: list[str]) -> None:
        scan = self.aligner.scanned(cuts)
        a_last, b_last = scan.a[scan.upto_a - 1], scan.b[scan.upto_b - 1]
        groups = list(map(str.__add__, map(self.a_alone.__getitem__, a_last.tolist()), map(self.b_text.__getitem__, b_last.tolist())))
        # those of several ids
        a, b = scan.a.tolist(), scan.b.tolist()
        a_from, b_from = np.r_[0, scan.upto_a[:-1]], np.r_[0, scan.upto_b[:-1]]
        several = np.flatnonzero((scan.upto_a - a_from > 1) | (scan.upto_b - b_from > 1))
        for k, i, p, j, q in zip(*(x.tolist() for x in (several, a_from[several], scan.upto_a[several], b_from[several], scan.upto_b[several])), strict=True):
            groups[k] = f"{','.join(map(str, a[i:p]))}|{','.join(map(str, b[j:q]))}"
        pairs = (a_last << B_BITS | b_last).tobytes()
        n = np.bincount(scan.cut, minlength=len(cuts))
        last = np.cumsum(n)
        # ids before each cut: those up to the end of the last group before it, as every cut ends with a group
        a_upto, b_upto = np.r_[0, scan.upto_a][last].tolist(), np.r_[0, scan.upto_b][last].tolist()
        low = i = j = 0
        for cut, spelt, high, p, q in zip(cuts, scan.spelt.tolist(), last.tolist(), a_upto, b_upto, strict=True):
            self.known[cut] = (p - i, q - j, high - low, ";".join(groups[low:high]), pairs[8 * low : 8 * high]) if spelt else None
            low, i, j = high, p, q


@lru_cache(maxsize=1)
def memory(a_path: str, b_path: str) -> Memory:
    """A worker's memory."""
    return Memory(Aligner(a_path, b_path))


#: Columns that a text has by itself, and all of the result.
SUMS = ["n_a", "n_b", "n_groups", "groups_sha256"]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def measured(own: Memory, texts: list[str]) -> Iterator[tuple[tuple[int, int, int, str], bytes]]:
    """SUMS and the linked pairs of each text."""
    for cuts in own.rows(texts):
        entries = [own.known[c] for c in cuts]
        if not entries or None in entries:
            yield (0, 0, 0, ""), b""
            continue
        a, b, groups, written, pairs = zip(*entries, strict=True)
        yield (sum(a), sum(b), sum(groups), hashlib.sha256(";".join(written).encode()).hexdigest()), b"".join(pairs)


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and groups: array of (ids of A, ids of B, where their bytes end in a space and the text); null where there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = memory(a_path, b_path).aligner
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("end", pa.int32())]))
        for batch in batches:
            rows = [own.groups(t) for t in texts_of(batch.column(1))]
            groups = pa.array([r and [{"a": a, "b": b, "end": end} for a, b, end in r] for r in rows], kind)
            yield pa.record_batch([batch.column(0), groups], names=["doc_id", "groups"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, groups array<struct<a:array<int>,b:array<int>,end:int>>")


#: A row that every chunk has in the table of pairs, so that chunks without links are answered too.
NO_PAIR = -1


def stored_links(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> tuple[str, DataFrame]:
    """Chunks of documents' sums and links below a folder, and the stored table (chunk, place, pair, n) of their distinct pairs."""
    url = shared_dir(docs.sparkSession, "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        own = memory(a_path, b_path)
        fs, path = file_system(url)
        fs.create_dir(path, recursive=True)
        ids: list[pa.Array] = []
        numbers: list[tuple[int, int, int, str]] = []
        links: list[bytes] = []
        size = count = 0

        def put() -> pa.RecordBatch:
            chunk = number_of(task.partitionId(), count)
            pairs, place, n = np.unique(np.frombuffer(b"".join(links), dtype=np.int64), return_inverse=True, return_counts=True)
            places = place.astype("<i4").tobytes()
            ends = np.cumsum([len(x) // 2 for x in links]).tolist()
            columns = [pa.chunked_array(ids).combine_chunks(), *(pa.array(x) for x in zip(*numbers, strict=True))]
            put_table(fs, path, chunk, task.taskAttemptId(), pa.table([*columns, pa.array([places[low:high] for low, high in zip([0, *ends], ends, strict=False)], pa.binary())], names=["doc_id", *SUMS, "links"]))
            pairs, n, place = np.r_[NO_PAIR, pairs], np.r_[0, n], np.arange(-1, len(pairs), dtype=np.int32)
            return pa.record_batch([pa.array(np.full(len(pairs), chunk)), pa.array(place), pa.array(pairs), pa.array(n)], names=["chunk", "place", "pair", "n"])

        # nothing here is cyclic, and the memory's many objects are dear to look through again and again
        gc.disable()
        try:
            for batch in slices(batches):
                texts = texts_of(batch.column(1))
                ids.append(batch.column(0))
                for row, pairs in measured(own, texts):
                    numbers.append(row)
                    links.append(pairs)
                size += sum(map(len, texts))
                if size >= chunk_bytes:
                    yield put()
                    ids, numbers, links, size, count = [], [], [], 0, count + 1
            if ids:
                yield put()
        finally:
            gc.enable()

    return url, stored(id_and_text(docs).mapInArrow(run, "chunk long, place int, pair long, n long"), "pairs")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, count (links of the corpus that hold it) and top: whether no pair with its id of B has more."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("top"))


def alignment(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text."""
    url, pairs = stored_links(docs, a_path, b_path, chunk_bytes)
    told = stored(pair_counts(pairs), "counts")
    answers = pairs.select("chunk", "place", "pair").join(told, "pair").select("chunk", "place", "count", "top")

    def sums(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        place = rows.column("place").to_numpy() + 1
        count, top = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        count[place], top[place] = rows.column("count").to_numpy(), rows.column("top").to_numpy()
        docs = read(url, chunk)
        links = [np.frombuffer(x, dtype="<i4") + 1 for x in docs.column("links").to_pylist()]
        more = {"n_links": [len(x) for x in links], "n_best": [int(top[x].sum()) for x in links], "count_sum": [int(count[x].sum()) for x in links]}
        own = docs.drop_columns(["links"])
        for name, values in more.items():
            own = own.append_column(name, pa.array(values, pa.int64()))
        return own.select(COLUMNS)

    return by(answers, "chunk").applyInArrow(sums, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in COLUMNS))
