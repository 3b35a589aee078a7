"""Aligning the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes. A token overlaps tokens of the other
tokenizer, and what overlaps in turn forms a group that ends where tokens of
both end. Every token points to the farthest-right token that overlaps it; the
pointers are doubled, for all tokens of a batch of documents at once, until
each shows its group's terminal token, which labels the group.

Links between ids are counted over the corpus. Two tokens that end at the same
byte of one text are, as bytes, one the end of the other. So the vocabularies
alone bound the number of id pairs, and the table of their counts reaches every
task whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep
from millrace.llm.tokens import KEPT_PIECES, Encoder, Known, worker_kept
from millrace.session import Workspace

# Bytes of texts that are aligned at once; a longer text is a batch of its own.
BATCH_BYTES = 2_000_000
SPACE = "▁"
ALIGNED = "doc_id long, n_a long, n_b long, groups_sha256 string, pairs binary, times binary"
# Fixed value: how a piece spells a single byte.
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def read_model(path: str) -> bytes:
    """The sentence-piece model's file, about half a MB; tasks get it by value."""
    with open(path, "rb") as file:
        return file.read()


def byte_level_vocabulary(definition: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer."""
    from tokenizers.pre_tokenizers import ByteLevel

    # Signs of the alphabet in the order of code points: the printable ones of
    # Latin-1 spell themselves, the others the remaining bytes in their order.
    signs = sorted(ByteLevel.alphabet())
    own = [ord(s) for s in signs if ord(s) < 256]
    rest = [b for b in range(256) if b not in own]
    table = dict(zip(signs, [*own, *rest], strict=True))
    read = json.loads(definition)
    words = dict(read["model"]["vocab"])
    found = [b""] * (max([*words.values(), *(t["id"] for t in read["added_tokens"])]) + 1)
    for word, number in words.items():
        found[number] = bytes(table[s] for s in word) if all(s in table for s in word) else word.encode()
    for token in read["added_tokens"]:
        found[token["id"]] = token["content"].encode()
    return found


class PieceEncoder:
    """Ids of a sentence-piece tokenizer that puts a space before a text, word by word.

    No piece reaches from a word over the next space, so words between spaces,
    each with the spaces before it, can be encoded apart and be kept; else the
    whole text is encoded. A text whose pieces do not spell it has no ids.
    """

    def __init__(self, model: bytes, kept_pieces: int = KEPT_PIECES):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.processor.id_to_piece(k) for k in range(self.processor.vocab_size())]
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.bytes = [self._bytes(p) for p in pieces]
        self.words = Known(self._word, kept_pieces)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        single = BYTE_PIECE.fullmatch(piece)
        return bytes([int(single[1], 16)]) if single else piece.replace(SPACE, " ").encode()

    def _word(self, word: str) -> bytes | None:
        """Ids of a text with the space before it, or None if they do not spell it."""
        ids = self._ids(word[1:])
        if b"".join(map(self.bytes.__getitem__, ids)) != word.encode():
            return None
        return array("I", ids).tobytes()

    def _ids(self, text: str) -> list[int]:
        if text:
            return self.processor.encode(text, num_threads=1)
        # The library gives nothing for nothing, not even the space.
        return [self.processor.piece_to_id(SPACE)]

    def encode(self, text: str) -> bytes | None:
        if not self.apart:
            return self._word(" " + text)
        words = list(map(self.words.__getitem__, re.findall(r" +[^ ]*", " " + text)))
        return None if None in words else b"".join(words)


class Aligner:
    """Both encoders and the tables that turn ids into lengths and decimals."""

    def __init__(self, definition: str, model: bytes):
        self.a = Encoder(definition, special_names=False)
        self.b = PieceEncoder(model)
        spelt = byte_level_vocabulary(definition)
        self.n_a, self.n_b = len(spelt), len(self.b.bytes)
        self.length_a = np.array([len(x) for x in spelt], np.int64)
        self.length_b = np.array([len(x) for x in self.b.bytes], np.int64)
        # An id in decimals with what follows it, by id and, further on, by id where it ends its group.
        signs = [(self.n_a, b","), (self.n_a, b"|"), (self.n_b, b","), (self.n_b, b";")]
        self.spelling = [b"%d%s" % (k, sign) for n, sign in signs for k in range(n)]

    def align(self, texts: list[str | None]) -> list[tuple]:
        """For each text ``n_a, n_b, groups_sha256, pairs, times``, see ``align_documents``."""
        ids_a, ids_b = [], []
        for text in texts:
            b = self.b.encode(text) if text else None
            a = self.a.encode([" " + text])[0] if b else b""
            ids_a.append(np.frombuffer(a, "<u4"))
            ids_b.append(np.frombuffer(b or b"", "<u4"))
            if b and self.length_a[ids_a[-1]].sum() != self.length_b[ids_b[-1]].sum():
                ids_a[-1] = ids_b[-1] = np.zeros(0, np.uint32)
        n_a, n_b = ([len(i) for i in ids] for ids in (ids_a, ids_b))
        a, b = (np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64) for ids in (ids_a, ids_b))
        # The texts follow one another; as both tokenizers spell each of them,
        # the offsets agree and no group reaches over a text's end.
        group_a, group_b, last_a, last_b = groups(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]))
        pairs = a[last_a] * self.n_b + b[last_b]
        code_a, code_b = a, b + 2 * self.n_a
        code_a[last_a] += self.n_a
        code_b[last_b] += self.n_b
        # A group's tokens of the first kind, then those of the second.
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        codes = np.concatenate([code_a, code_b])[order].tolist()
        rows, at, link = [], 0, 0
        ends = np.searchsorted(last_b, np.cumsum(n_b), side="left").tolist()
        for count_a, count_b, end in zip(n_a, n_b, ends, strict=True):
            spelt = b"".join(map(self.spelling.__getitem__, codes[at : at + count_a + count_b]))[:-1]
            at += count_a + count_b
            found, times = np.unique(pairs[link:end], return_counts=True)
            link = end
            digest = hashlib.sha256(spelt).hexdigest() if spelt else ""
            rows.append((count_a, count_b, digest, found.astype("<u8").tobytes(), times.astype("<u4").tobytes()))
        return rows


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The group of every token of both kinds, and each group's last token of both.

    ``ends`` are the offsets behind the tokens, rising, the last ones equal. A
    token's farthest-right overlap is the token of the other kind that holds its
    last byte, if that one ends later; where both end together, the first kind
    points to the second, whose token is the terminal one.
    """
    n_a = len(ends_a)
    to_b = n_a + np.searchsorted(ends_b, ends_a, side="left")
    holder = np.searchsorted(ends_a, ends_b, side="left")
    own = np.arange(n_a, n_a + len(ends_b))
    # A token of the second kind is terminal where the one that holds its end ends there.
    to_a = np.where(ends_a[holder] > ends_b, holder, own) if n_a else own
    successor = np.concatenate([to_b, to_a])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    terminal = successor[n_a:] == own
    number = np.cumsum(terminal) - 1
    label = number[successor - n_a]
    last_b = np.flatnonzero(terminal)
    return label[:n_a], label[n_a:], holder[last_b], last_b


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of rows of a few MB together."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size > BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    yield ids, texts


def align_documents(
    docs: DataFrame, definition: str, model: bytes, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, groups_sha256, pairs, times`` of every row.

    ``pairs`` are the document's linked pairs, as little-endian unsigned 64-bit
    numbers (id of the first kind times the second's vocabulary, plus the other
    id), and ``times`` how often each occurs, in 32 bits.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_kept("aligners", definition.encode() + model, lambda: Aligner(definition, model))
        for ids, texts in _batches(batches):
            columns = list(zip(*aligner.align(texts), strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            arrays = [pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.record_batch(arrays, names)

    names = [part.split()[0] for part in ALIGNED.split(", ")]
    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return chosen.mapInArrow(align, ALIGNED)


def pair_counts(aligned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of the whole corpus in order, and their counts.

    A task adds up its own rows before they are shuffled. The result's size is
    bounded by the vocabularies, see the module's description.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            pairs, times, _ = _flat(batch)
            known, place = np.unique(np.concatenate([known, pairs]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([sums, times])).astype(np.int64)
        yield pa.record_batch([pa.array(known.astype(np.int64)), pa.array(sums, pa.int64())], ["pair", "n"])

    each = aligned.select("pairs", "times").mapInArrow(count, "pair long, n long")
    found = each.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs, counts = (found.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    order = np.argsort(pairs)
    return pairs[order], counts[order]


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all rows one after the other, and the row of each."""
    rows = batch.column("pairs").to_pylist()
    times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
    return np.frombuffer(b"".join(rows), "<u8"), times, np.repeat(np.arange(len(rows)), [len(r) // 8 for r in rows])


def align_tokens(
    docs: DataFrame, definition: str, model: bytes, work: Workspace, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    The first tokenizer (a byte-level definition) gets a space and the text, the
    second (a sentence-piece model, which puts the space there itself) the text;
    names of special tokens are ordinary text. Offsets where tokens of both end
    cut them into groups, and each such offset links the two tokens ending
    there. A pair's count is the number of its links in all rows, ``count_sum``
    adds it up over a row's links, and ``n_best`` counts the links whose pair is
    a most frequent one of its second id.

    NULL and empty texts, and texts that the tokens of either do not spell, have
    no tokens: zeros and an empty digest. Rows that repeat others are rows like
    others and count in the pairs; a very long text is one batch; an empty table
    gives no rows. Other columns of the input are not looked at, whatever their
    names.
    """
    aligned = keep(align_documents(docs, definition, model, id_col=id_col, text_col=text_col), work, "aligned")
    pairs, counts = pair_counts(aligned)
    vocabulary = len(PieceEncoder(model, 1).bytes)
    best = np.zeros(vocabulary, np.int64)
    np.maximum.at(best, pairs % vocabulary, counts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, times, row = _flat(batch)
            found = found.astype(np.int64)
            count = counts[np.searchsorted(pairs, found)]
            sums = []
            for values in (times, times * (count == best[found % vocabulary]), times * count):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, values)
                sums.append(pa.array(total))
            links, at_best, count_sum = sums
            whole = [batch.column(c) for c in ("doc_id", "n_a", "n_b")]
            yield pa.record_batch([*whole, links, links, at_best, count_sum, batch.column("groups_sha256")], out)

    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in out)
    return aligned.mapInArrow(score, schema)
