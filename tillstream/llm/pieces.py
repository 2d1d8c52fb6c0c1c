"""SentencePiece BPE: encoding by a table of each prefix's last token, and decoding.

The encoding of a prefix of a text is the encoding of a shorter prefix and one more token, and a
sequence of tokens is an encoding exactly if each pair of neighbours stays as it is when their text
is merged alone. So one pass over a text suffices: an automaton reports the pieces that end at each
character, and the one that fits the last token of the prefix before it is that prefix's unique last
token. The ids are read backwards from the end.

The pass treats a stretch of text from one word mark to the next, where no piece reaches across a
word mark, and remembers the stretches it has met. Runs of word marks, whose pieces all have one
score so that the leftmost is merged first, are merged directly.

Text is taken whole. A null or empty text has no token but the end id, and decodes to an empty text.
Characters that the vocabulary lacks become byte tokens. Columns of the table that are named like a
result are replaced. Repeated rows are encoded each; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
#: Bytes of stretches that a task remembers, in each of two generations.
REMEMBERED_BYTES = 48 << 20
#: Pairs of tokens whose fit a worker remembers (some 100 bytes each).
REMEMBERED_PAIRS = 400_000
#: What a remembered stretch takes besides its word and ids.
ENTRY_BYTES = 200
#: A stretch longer than this is not remembered.
LONGEST = 64
#: Characters of text whose ids are built before a batch goes out.
BATCH_CHARS = 4_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a BPE model in the order of their ids, with scores and kinds (normal, byte, control, unknown)."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]
    end: int

    @staticmethod
    def load(model_file: str) -> Vocabulary:
        """Read on the driver; executors need no file. Its size is bounded by the model's vocabulary."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        kinds = [
            "byte" if model.is_byte(i) else "control" if model.is_control(i)
            else "unknown" if model.is_unknown(i) else "normal"
            for i in ids
        ]
        return Vocabulary(
            [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], kinds, model.eos_id()
        )


@dataclass
class Encoder:
    """Encodes texts with a vocabulary."""

    vocabulary: Vocabulary
    met: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    held: int = 0

    def __post_init__(self) -> None:
        import ahocorasick

        v = self.vocabulary
        self.ids = {p: i for i, (p, kind) in enumerate(zip(v.pieces, v.kinds)) if kind == "normal"}
        self.bytes = [v.pieces.index(f"<0x{n:02X}>") for n in range(256)]
        self.score = {p: v.scores[i] for p, i in self.ids.items()}
        self.end = array("i", [v.end]).tobytes()
        self.mark = array("i", [self.ids.get(MARK, -1)]).tobytes()
        self.fits: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.runs: dict[int, list[str]] = {}
        # A mark can only stand at the start of a piece, or the piece is a run of marks.
        self.by_word = not any(MARK in p[1:] and p.strip(MARK) for p in self.ids)
        plain = [s for p, s in self.score.items() if p.strip(MARK)]
        marks = [s for p, s in self.score.items() if len(p) > 1 and not p.strip(MARK)]
        self.by_word &= not marks or not plain or max(marks) < min(plain)
        self.tied = len(set(plain)) < len(plain)
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if self.merged(p) == [p]:
                self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """The definition: merge the pair of neighbours with the best score, the leftmost of equals, until none is left."""
        part, n = list(text), len(text)
        if n < 2:
            return part
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        score, heap = self.score, []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (s := score.get(part[left] + part[right])) is not None:
                heapq.heappush(heap, (-s, left, right, len(part[left]) + len(part[right])))

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if not part[left] or not part[right] or len(part[left]) + len(part[right]) != size:
                continue
            part[left] += part[right]
            part[right] = ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in part if p]

    def stay(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are when their text is merged alone."""
        if self.pairs > REMEMBERED_PAIRS:
            self.fits.clear()
            self.pairs = 0
        self.pairs += 1
        known = self.fits.setdefault(left, {})[right] = self.merged(left + right) == [left, right]
        return known

    def by_prefixes(self, text: str) -> list[str]:
        """The tokens of a text, from the table of each prefix's last token."""
        if self.tied:
            return self.merged(text)
        # The automaton reports pieces by their ends, the longest first. A place that none of them ends at has a
        # character that is not in the vocabulary, which is a token of its own.
        last: list[str | None] = [None] * len(text)
        fits, nothing = self.fits.get, {}
        for at, (piece, size) in self.automaton.iter(text):
            if last[at]:
                continue
            end = at - size  # of the prefix before the piece
            if end >= 0:
                before = last[end] or text[end]
                known = fits(before, nothing).get(piece)
                if not (self.stay(before, piece) if known is None else known):
                    continue
            last[at] = piece
        tokens, at = [], len(text) - 1
        while at >= 0:
            token = last[at] or text[at]
            tokens.append(token)
            at -= len(token)
        return tokens[::-1]

    def as_ids(self, tokens: list[str]) -> array:
        ids = array("i")
        for token in tokens:
            if (known := self.ids.get(token)) is not None:
                ids.append(known)
            else:
                ids.extend(self.bytes[b] for b in token.encode())
        return ids

    def run(self, length: int) -> list[str]:
        """The tokens of a run of word marks."""
        if length not in self.runs:
            if len(self.runs) > 1000:
                self.runs.clear()
            self.runs[length] = self.merged(MARK * length)
        return self.runs[length]

    def stretch(self, word: str) -> bytes:
        """The ids of a word mark and the word behind it, as 32-bit integers laid end to end."""
        if (known := self.met.get(word)) is None:
            if (known := self.older.get(word)) is None:
                known = self.as_ids(self.by_prefixes(MARK + word)).tobytes()
            if len(word) <= LONGEST:
                if self.held > REMEMBERED_BYTES:  # what is not met again is forgotten with the older ones
                    self.older, self.met, self.held = self.met, {}, 0
                self.met[word] = known
                self.held += ENTRY_BYTES + 2 * len(word) + len(known)
        return known

    def packed(self, text: str | None) -> bytes:
        """The ids of a text and the end id, as 32-bit integers laid end to end."""
        if not text:
            return self.end
        if not self.by_word:
            return self.as_ids(self.merged(MARK + text.replace(" ", MARK))).tobytes() + self.end
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            return self._with_runs(words) + self.end
        for word in set(words).difference(self.met):
            self.stretch(word)
        try:
            return b"".join(map(self.met.__getitem__, words)) + self.end
        except KeyError:  # a long word, or some were just forgotten
            return b"".join(map(self.stretch, words)) + self.end

    def _with_runs(self, words: list[str]) -> bytes:
        """Words with empty ones between them, where several marks stand together."""
        parts, marks = [], 0
        for word in words:
            if not word:
                marks += 1
                continue
            known = self.stretch(word)
            if marks:
                # The word takes the last mark of the run if a piece joins them.
                alone = known[:4] == self.mark
                parts.append(self.as_ids(self.run(marks + alone)).tobytes())
                parts.append(known[4:] if alone else known)
                marks = 0
            else:
                parts.append(known)
        if marks:
            parts.append(self.as_ids(self.run(marks)).tobytes())
        return b"".join(parts)

    def forget(self) -> None:
        """A task's end: a worker may serve other stages next. Pairs stay, as the next task would judge the same ones again."""
        self.met, self.older, self.held, self.runs = {}, {}, 0, {}

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text and the end id."""
        return array("i", self.packed(text)).tolist()


@dataclass
class Decoder:
    """Gives the text of ids."""

    vocabulary: Vocabulary

    def __post_init__(self) -> None:
        texts = {"control": lambda p: "", "unknown": lambda p: " ⁇ ", "normal": lambda p: p.replace(MARK, " ")}
        v = self.vocabulary
        self.raw = [
            bytes([int(p[3:5], 16)]) if kind == "byte" else texts[kind](p).encode()
            for p, kind in zip(v.pieces, v.kinds)
        ]
        self.kinds = v.kinds
        self.controls = {i for i, kind in enumerate(v.kinds) if kind == "control"}

    def decode(self, ids: list[int]) -> str:
        """Byte tokens that are not UTF-8 together become one replacement character each."""
        body = list(map(self.raw.__getitem__, ids))
        start = next((k for k, i in enumerate(ids) if self.kinds[i] != "control"), len(ids))
        if start < len(ids) and self.kinds[ids[start]] == "normal" and body[start][:1] == b" ":
            body[start] = body[start][1:]
        if self.controls.isdisjoint(ids[:-1]):  # one in the middle parts the bytes on its sides
            try:
                return b"".join(body).decode()
            except UnicodeDecodeError:
                pass
        return self._mended(ids, body)

    def _mended(self, ids: list[int], body: list[bytes]) -> str:
        out, run = [], bytearray()
        for i, raw in zip([*ids, -1], [*body, b""]):
            if i >= 0 and self.kinds[i] == "byte":
                run += raw
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if _is_char(run[:n])), 0)
                out.append(run[:size].decode() if size else "�")
                del run[: size or 1]
            out.append(raw.decode())
        return "".join(out)


def _is_char(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


_encoders: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One for each worker and vocabulary."""
    sign = (len(vocabulary.pieces), hash(tuple(vocabulary.pieces)), vocabulary.end)
    if sign not in _encoders:
        _encoders.clear()
        _encoders[sign] = Encoder(vocabulary)
    return _encoders[sign]


def _replaced(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c.lower() != column.lower()]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], [*kept, column])


def _slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose sizes add up to `most`, or of one row."""
    first = total = 0
    for k, size in enumerate(sizes.to_pylist()):
        if total and total + (size or 0) > most:
            yield batch.slice(first, k - first)
            first, total = k, 0
        total += size or 0
    if first < batch.num_rows:
        yield batch.slice(first)


def _schema(table: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in table.schema if f.name.lower() != column.lower()), T.StructField(column, kind)])


def _id_lists(encoder: Encoder, texts: list[str | None]) -> pa.ListArray:
    found = list(map(encoder.packed, texts))
    at = array("i", accumulate((len(f) // 4 for f in found), initial=0))
    flat = b"".join(found)
    return pa.ListArray.from_arrays(
        pa.Array.from_buffers(pa.int32(), len(at), [None, pa.py_buffer(at)]),
        pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)]),
    )


def _texts(decoder: Decoder, ids: pa.ListArray) -> pa.Array:
    flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
    return pa.array([decoder.decode(flat[a:b].tolist()) for a, b in zip(at, at[1:])], pa.string())


def _encoding(docs: DataFrame, vocabulary: Vocabulary, text_column: str, ids_column: str, decoded: str | None) -> DataFrame:
    import pyarrow.compute as pc

    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder, decoder = _encoder(sent.value), Decoder(sent.value) if decoded else None
        try:
            for batch in batches:
                for part in _slices(batch, pc.utf8_length(batch.column(text_column)), BATCH_CHARS):
                    ids = _id_lists(encoder, part.column(text_column).to_pylist())
                    if decoded:
                        part = _replaced(part, decoded, _texts(decoder, ids))
                    yield _replaced(part, ids_column, ids)
        finally:
            encoder.forget()

    fields = [f for f in docs.schema if f.name.lower() not in (ids_column.lower(), (decoded or ids_column).lower())]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(ids_column, T.ArrayType(T.IntegerType()))]))


def encode(docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """The table with the ids of each text, an end id last."""
    return _encoding(docs, vocabulary, text_column, ids_column, None)


def encode_and_decode(
    docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", ids_column: str = "ids", decoded_column: str = "decoded",
) -> DataFrame:
    """The table with the ids of each text and the text that they decode to, in one step, so one worker for each core."""
    return _encoding(docs, vocabulary, text_column, ids_column, decoded_column)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """The table with the text of each row's ids."""
    import pyarrow.compute as pc

    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        decoder = Decoder(sent.value)
        for batch in batches:
            for part in _slices(batch, pc.list_value_length(batch.column(ids_column)), BATCH_CHARS // 2):
                column = part.column(ids_column)
                yield _replaced(part, text_column, _texts(decoder, column))

    return encoded.mapInArrow(run, _schema(encoded, text_column, T.StringType()))
