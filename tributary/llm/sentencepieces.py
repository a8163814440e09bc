"""SentencePiece encoding that keeps every piece's place in the original text.

Normalisation is done here: the longest prefix of the rest of the text that is
a user symbol or a key of the model's compiled character map (a double-array
trie) is replaced, and every byte of the result remembers the source byte it
came from.  The installed library merges pieces in that text, by a copy of the
model whose own normaliser changes nothing; the byte lengths of its pieces laid
end to end cover the normalised text and are projected through the alignment to
byte spans of the original.

Defined cases: a null text is empty; an empty text has no pieces; texts of
any length are encoded whole; repeated rows and null ids keep their rows; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import map_rows

SPACE = "▁".encode()
USER_DEFINED, BYTE, CONTROL, UNKNOWN = 4, 6, 3, 2  # fixed values: piece types of the model format
REPLACEMENT = "�".encode()


def fields(raw: bytes):
    """(number, value) of the fields of a serialised protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, raw[at : at + n]
            at += n


@dataclass(frozen=True)
class Rules:
    """What the model says about normalisation."""

    units: np.ndarray
    targets: bytes
    symbols: tuple[bytes, ...] = ()
    dummy_prefix: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True
    space_as_suffix: bool = False

    @property
    def plain(self) -> bool:
        """Only spaces change: nothing is mapped, matched or stripped."""
        return not len(self.units) and not self.symbols and not self.strip_spaces and not self.space_as_suffix


def rules_of(model: bytes) -> Rules:
    charsmap, symbols, options = b"", [], {3: 1, 4: 1, 5: 1}
    suffix = 0
    for number, value in fields(model):
        if number == 1:
            piece = dict(fields(value))
            if piece.get(3) == USER_DEFINED:
                symbols.append(piece[1])
        elif number == 2:
            suffix = dict(fields(value)).get(24, 0)
        elif number == 3:
            options |= dict(fields(value))
            charsmap = options.get(2, b"")
    size = struct.unpack_from("<I", charsmap)[0] if charsmap else 0
    units = np.frombuffer(charsmap[4 : 4 + size], dtype="<u4")
    return Rules(units, charsmap[4 + size :], tuple(sorted(symbols, key=len, reverse=True)), bool(options[3]), bool(options[4]), bool(options[5]), bool(suffix))


def longest_prefix(rules: Rules, text: bytes, at: int) -> tuple[bytes, int]:
    """The replacement of the longest mapped prefix of ``text[at:]`` and the prefix's length."""
    for symbol in rules.symbols:
        if text.startswith(symbol, at):
            return symbol, len(symbol)
    if len(rules.units):
        units = rules.units
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node, length, target = step(int(units[0])), 0, 0
        for k in range(at, len(text)):
            node ^= text[k]
            unit = int(units[node])
            if unit & 0x800000FF != text[k]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                length, target = k + 1 - at, int(units[node]) & 0x7FFFFFFF
        if length:
            return rules.targets[target : rules.targets.index(b"\0", target)], length
    first = text[at]
    length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
    return text[at : at + length], length


def normalised(rules: Rules, text: bytes) -> tuple[bytes, np.ndarray]:
    """The normalised text and, for each of its bytes and its end, the source byte it stands for."""
    space = SPACE if rules.escape_spaces else b" "
    if not text:
        return b"", np.zeros(1, dtype=np.int64)
    if rules.plain:
        source = np.frombuffer(text, dtype=np.uint8)
        origin = np.repeat(np.arange(len(text)), np.where(source == 0x20, len(space), 1))
        prefix = space if rules.dummy_prefix else b""
        return prefix + text.replace(b" ", space), np.concatenate([np.zeros(len(prefix), dtype=np.int64), origin, [len(text)]])
    out, origin, at = bytearray(), [], 0
    if rules.strip_spaces:
        while at < len(text):
            piece, n = longest_prefix(rules, text, at)
            if piece != b" ":
                break
            at += n
        if at == len(text):
            return b"", np.zeros(1, dtype=np.int64)
    dummy = rules.dummy_prefix
    if dummy and not rules.space_as_suffix:
        out += space
        origin += [at] * len(space)
    after_space = rules.strip_spaces
    while at < len(text):
        piece, n = longest_prefix(rules, text, at)
        while after_space and piece.startswith(b" "):
            piece = piece[1:]
        if piece:
            for byte in piece:
                put = space if byte == 0x20 else bytes([byte])
                out += put
                origin += [at] * len(put)
            after_space = piece.endswith(b" ")
        at += n
        if not rules.strip_spaces:
            after_space = False
    if rules.strip_spaces:
        while out.endswith(space):
            del out[-len(space):]
            at = origin[len(out)]
            del origin[len(out):]
    if dummy and rules.space_as_suffix:
        out += space
        origin += [at] * len(space)
    return bytes(out), np.array([*origin, at])


def message(parts: list[tuple[int, bytes]]) -> bytes:
    """A serialised message of fields with lengths."""

    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    return b"".join(varint(number << 3 | 2) + varint(len(value)) + value for number, value in parts)


def without_normaliser(model: bytes) -> bytes:
    """The model with a normaliser that leaves every text as it is: no map, prefix, stripping or escaping."""
    nothing = bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 0])
    return message([(n, v) for n, v in fields(model) if n != 3]) + message([(3, message([(1, b"identity")]) + nothing)])


@dataclass(frozen=True)
class Model:
    processor: sentencepiece.SentencePieceProcessor  # decodes
    merger: sentencepiece.SentencePieceProcessor  # segments normalised text
    rules: Rules
    lengths: np.ndarray  # bytes of each piece; byte pieces have one, unknown ones -1


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    with open(path, "rb") as handle:
        raw = handle.read()
    lengths = []
    for number, value in fields(raw):
        if number == 1:
            piece = dict(fields(value))
            kind = piece.get(3, 1)
            lengths.append({BYTE: 1, UNKNOWN: -1, CONTROL: 0}.get(kind, len(piece[1])))
    return Model(sentencepiece.SentencePieceProcessor(model_proto=raw), sentencepiece.SentencePieceProcessor(model_proto=without_normaliser(raw)), rules_of(raw), np.array(lengths, dtype=np.int64))


def piece_lengths(model: Model, plain: str, ids: np.ndarray) -> np.ndarray:
    """Bytes of the normalised text that each piece covers."""
    lengths = model.lengths[ids]
    if (lengths < 0).any():  # unknown pieces have the text they stand for
        pieces = model.merger.encode(plain, out_type=str)
        lengths = np.where(lengths < 0, [len(p.encode()) for p in pieces], lengths)
    return lengths


def spans(model: Model, plain: bytes, origin: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte in the source of every piece of a normalised text."""
    ends = np.cumsum(piece_lengths(model, plain.decode(), ids))
    if (int(ends[-1]) if len(ends) else 0) != len(plain):
        raise ValueError("pieces do not cover the normalised text")
    places = origin[np.concatenate([[0], ends])]
    return places[:-1], places[1:]


def encoded(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, kept columns, ids, begins, ends, decoded, spans_sha256): the pieces of ``text``, their byte spans, and the text decoded from the ids.

    The digest is of all begins and then all ends, as little-endian 32-bit numbers.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = load(model_path)
        texts = batch.column("text").to_pylist()
        plain = [normalised(model.rules, text.encode()) for text in texts]
        ids = pa.array(model.merger.encode([text.decode() for text, _ in plain], num_threads=1), pa.list_(pa.int32()))
        flat, cuts = ids.values.to_numpy(), ids.offsets.to_numpy()
        begins, ends = np.empty(len(flat), dtype="<i4"), np.empty(len(flat), dtype="<i4")
        sums = []
        for (text, origin), a, b in zip(plain, cuts, cuts[1:]):
            begins[a:b], ends[a:b] = spans(model, text, origin, flat[a:b])
            sums.append(hashlib.sha256(begins[a:b].tobytes() + ends[a:b].tobytes()).hexdigest())
        listed = lambda v: pa.ListArray.from_arrays(ids.offsets, pa.array(v))
        decoded = model.processor.decode(ids.to_pylist(), num_threads=1)
        kept = [batch.column(c) for c in ("doc_id", *keep)]
        return pa.RecordBatch.from_arrays([*kept, ids, listed(begins), listed(ends), pa.array(decoded, pa.string()), pa.array(sums, pa.string())], ["doc_id", *keep, "ids", "begins", "ends", "decoded", "spans_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keep)
    kinds = dict(docs.dtypes)
    return map_rows(rows, work, "doc_id long, " + "".join(f"{c} {kinds[c]}, " for c in keep) + "ids array<int>, begins array<int>, ends array<int>, decoded string, spans_sha256 string")


def digests(encoding: DataFrame, *keep: str) -> DataFrame:
    """Per document: number of pieces, digests of ids and decoded text, and the bytes its spans cover."""
    first, last = F.coalesce(F.try_element_at("begins", F.lit(1)), F.lit(0)), F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0))
    return encoding.select(
        "doc_id", *keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (last - first).cast("long").alias("span_bytes"), "spans_sha256")
