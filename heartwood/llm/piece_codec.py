"""Text to SentencePiece ids and back, by an Aho-Corasick automaton and one Viterbi pass.

The automaton knows all pieces. One pass over the characters gives, at each position, the pieces
that end there: the longest from the state itself, the shorter ones over its output links. Each
relaxes the best score of the position. The result is the segmentation with the largest sum of
the file's scores, whatever algorithm the scores were trained with. Sums are exact to double
precision.

If no piece continues from a word into the space before the next one, the best segmentation of a
text is that of its words in turn; then each task keeps the words it has met lately.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import give_back, row_blocks, text_buffers

SPACE = "▁"
#: bytes (about) of a task's table of new words; when it is full, it becomes the old one, from
#: which words are taken over as they are met again
TABLE = 36 << 20
#: bytes of texts that are encoded or decoded at once
BLOCK = 1 << 20
#: an unknown character scores this much less than the worst piece
UNKNOWN_PENALTY = 10.0


class PieceDecoder:
    """Decoder of one vocabulary file."""

    def __init__(self, path: str):
        self._read(path)

    def _read(self, path: str):
        """The file, read; its pieces are set up for decoding."""
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        size = file.get_piece_size()
        names = [file.id_to_piece(i) for i in range(size)]
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if file.is_byte(i)}
        self.unknown = file.unk_id()
        self.plain = [
            i
            for i in range(size)
            if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i) or file.is_unused(i))
        ]
        #: what each id decodes to; control pieces to nothing
        self.shown = [b""] * size
        for i in self.plain:
            self.shown[i] = names[i].replace(SPACE, " ").encode()
        for value, i in self.bytes.items():
            self.shown[i] = bytes([value])
        self.shown[self.unknown] = " ⁇ ".encode()
        self.prefixed = file.normalize("a").startswith(SPACE)
        return file

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: bytes that are no UTF-8 become replacement characters, and the one
        space that encoding puts first is taken off."""
        shown = self.shown
        text = b"".join([shown[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefixed and text[:1] == " " else text


class PieceCodec(PieceDecoder):
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick

        self.file = file = self._read(path)
        names = {i: file.id_to_piece(i) for i in self.plain}
        self.automaton = ahocorasick.Automaton()
        for i in self.plain:
            self.automaton.add_word(names[i], (i, len(names[i]), file.get_score(i)))
        self.automaton.make_automaton()
        worst = min((file.get_score(i) for i in self.plain), default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", names[i]) for i in self.plain)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.table: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0  # of the table

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of normalised text."""
        n, unknown, penalty = len(text), self.unknown, self.unknown_score
        best = [0.0] + [-np.inf] * n
        begin, name = [0] * (n + 1), [unknown] * (n + 1)
        # at: the character whose pieces are being relaxed; lone: one of them is that character
        at, lone = 0, False
        for last, (piece, length, score) in self.automaton.iter(text):
            while at < last:
                if not lone and best[at] + penalty > best[at + 1]:
                    best[at + 1], begin[at + 1], name[at + 1] = best[at] + penalty, at, unknown
                at, lone = at + 1, False
            if length == 1:
                lone = True
            value = best[last + 1 - length] + score
            if value > best[last + 1]:
                best[last + 1], begin[last + 1], name[last + 1] = value, last + 1 - length, piece
        while at < n:
            if not lone and best[at] + penalty > best[at + 1]:
                best[at + 1], begin[at + 1], name[at + 1] = best[at] + penalty, at, unknown
            at, lone = at + 1, False
        ids: list[int] = []
        while at:
            start, piece = begin[at], name[at]
            if piece != unknown:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(text[start:at].encode()))
            elif not ids or ids[-1] != unknown:
                ids.append(piece)
            at = start
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian signed 32-bit numbers."""
        text = self.file.normalize(text)
        if not self.by_words:
            return np.array(self.segment(text), "<i4").tobytes()
        words = self.words.findall(text)
        table = self.table
        missing = set(words).difference(table)
        for w in missing:
            ids = self.old.get(w)
            table[w] = np.array(self.segment(w), "<i4").tobytes() if ids is None else ids
        ids = b"".join([table[w] for w in words])
        for w in missing:
            if len(w) > 1000:
                del table[w]
            else:  # objects and their place in the dict take some 200 bytes
                self.size += 200 + 2 * len(w) + len(table[w])
        if self.size > TABLE:
            self.old, self.table, self.size = table, {}, 0
        return ids


def _blocks(batch: pa.RecordBatch, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of the batch of few rows and about ``BLOCK`` bytes."""
    for lo in range(0, batch.num_rows, 500):
        hi = min(lo + 500, batch.num_rows)
        for first, last in row_blocks(offsets[lo : hi + 1], BLOCK):
            yield batch.slice(lo + first, last - first)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with piece_ids (array of ids) and ids_crc32 (of the ids as little-endian 32-bit
    numbers) of each whole text.

    A missing text has a null array and checksum, an empty one an empty array. All columns stay;
    those of the two new names are replaced. Without byte pieces in the file unknown characters on
    end share one unknown id.
    """
    new = ("piece_ids", "ids_crc32")
    rest = [c for c in docs.columns if c not in new]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(path)
        for batch in batches:
            for rows in _blocks(batch, text_buffers(batch.column("text"))[1]):
                data = [None if t is None else codec.encode(t) for t in rows.column("text").to_pylist()]
                offsets = np.cumsum([0] + [len(d or b"") // 4 for d in data]).astype(np.int32)
                ids = np.frombuffer(b"".join(d or b"" for d in data), "<i4")
                gone = pa.array([d is None for d in data])
                yield pa.record_batch(
                    {
                        **{c: rows.column(c) for c in rest},
                        "piece_ids": pa.ListArray.from_arrays(
                            pa.array(offsets), pa.array(ids, pa.int32()), mask=gone
                        ),
                        "ids_crc32": pa.array(
                            [None if d is None else zlib.crc32(d) for d in data], pa.int64()
                        ),
                    }
                )
        del codec
        give_back()

    return docs.select(*rest).mapInArrow(run, f"{kinds}, piece_ids array<int>, ids_crc32 long")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with decoded: the text of piece_ids (null where that is null). Other columns stay.

    Text that went through ``encode`` comes back as the file's normalisation leaves it, for a file
    without normalisation as it was; the mark for spaces (U+2581) itself comes back as a space.
    """
    rest = [c for c in rows.columns if c != "decoded"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceDecoder(path)
        for batch in batches:
            places = batch.column("piece_ids").offsets.to_numpy().astype(np.int64)
            for part in _blocks(batch, 4 * places):
                texts = [
                    codec.decode(x.values.to_numpy().tolist()) if x.is_valid else None
                    for x in part.column("piece_ids")
                ]
                yield pa.record_batch(
                    {
                        **{c: part.column(c) for c in rest},
                        "decoded": pa.array(texts, pa.string()),
                    }
                )
        del codec
        give_back()

    return rows.select(*rest).mapInArrow(run, f"{kinds}, decoded string")


def encoded_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_sha256 and round_trip (the decoded text equals the text;
    null for a missing text) of each row."""
    both = decode(encode(docs.select("doc_id", "text"), path), path)
    return both.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_ids"),
        "ids_crc32",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("text") == F.col("decoded")).alias("round_trip"),
    )
