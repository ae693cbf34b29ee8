"""Byte-pair encoding and decoding by tree concatenation.

A text is cut at ASCII white space, where neither normalisation nor merges reach across.  What is left between two
cuts is a *unit*.  Short units are encoded at once and remembered.  A long unit without white space is encoded in
halves (down to pieces of ``PIECE`` symbols); at each join a window of the last symbols of the left and the first of
the right side is encoded again and doubled until the window's first token and last token are those that the two
sides already have there.  A sequence in which every two neighbours are what their own text encodes to is the
encoding of the whole, so the result is exact, not an approximation.

Texts above ``LONG`` characters are dealt out: their pieces are encoded as rows of their own on many tasks, and only
the token ids of one document meet again, where the joins are made.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import cached_property
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.llm.common import begin, give_back, temporary

#: Symbols of a unit that are encoded in one go.
PIECE = 2048
#: Characters of a text from which its pieces are dealt out over the tasks.
LONG = 65536
#: Units in each of the two generations that a worker remembers.
REMEMBERED = 120_000
#: Bytes of a vocabulary file; it is sent to every worker.
VOCABULARY_BYTES = 64 << 20

#: Words for which lower-casing is all the normalisation there is; marks after them form a pre-token of their own.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
_MARKS = ".,;:!?|$%&*#()-"


class Codec:
    """Encoder and decoder of one vocabulary file in a worker process."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(vocabulary)
        self.whole.no_truncation()
        self.whole.no_padding()
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.strings = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.added_lower = [a.lower() for a in self.added]
        self.end = self.whole.model.end_of_word_suffix or ""
        self.closing = self.whole.model
        if hasattr(self.closing, "_resize_cache"):  # words are remembered here, a second memory only costs time
            self.closing._resize_cache(0)
        self.vocabulary = vocabulary
        # how the model's alphabet spells the lower-case letters beyond ASCII that plain words may have
        self.letters = {ord(c): self.pre_token(c) for c in "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"}
        self.plain = True
        self.units: dict[str, bytes] = _Memory(self._unit)
        apart = [self.whole.encode(t, add_special_tokens=False).ids for t in ("ab", "cd", "ab cd", " ab\n\tcd ")]
        if not apart[0] + apart[1] == apart[2] == apart[3]:
            raise ValueError("this vocabulary does not take words apart at white space")
        self.plain = self._is_plain()
        self.units.clear()

    @cached_property
    def inner(self):
        """The model for pieces that do not end a word."""
        from tokenizers import models

        model = json.loads(self.vocabulary)["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        return models.BPE(model["vocab"], merges)

    # -- encoding

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        text = _spaced(text)
        if self.plain:  # A-Z are a-z then, but in added tokens
            lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            text = text if any(a in lower for a in self.added_lower) else lower
        return b"".join(map(self.units.__getitem__, text.split(" ")))

    def _is_plain(self) -> bool:
        """Whether this vocabulary treats plain words, and marks after them, as ``_unit`` does."""
        letters = [chr(c) for c in range(0x250) if _PLAIN(chr(c))]
        units = [a + b for a in letters for b in ("", "b", *_MARKS)] + [f"a{c}{d}" for c in _MARKS for d in _MARKS]
        whole = self.whole.encode_batch([*units, "b" + "".join(letters)], add_special_tokens=False)
        return all(self._unit(u) == _packed(w.ids) for u, w in zip([*units, "b" + "".join(letters)], whole, strict=True))

    def _unit(self, unit: str) -> bytes:
        size = len(unit)
        if size <= PIECE:
            word = unit.rstrip(_MARKS)
            if self.plain and word.isalpha() and (word.isascii() or _PLAIN(word)):
                lower, at = word.lower(), len(word)
                if at < size:
                    return self.units[lower] + self.units[unit[at:]]
                return self._word(word) if lower == word else self.units[lower]
            return _packed(self.whole.encode(unit, add_special_tokens=False).ids)
        return b"".join(
            _packed([word]) if isinstance(word, int) else self.long_word(word) for word in self.pre_tokens(unit)
        )

    def pre_tokens(self, unit: str) -> Iterator[str | int]:
        """The words of a unit in the model's alphabet; ids where the unit holds an added token."""
        parts = re.split("(" + "|".join(map(re.escape, self.added)) + ")", unit) if self.added else [unit]
        for part in parts:
            if part in self.added:
                yield self.whole.token_to_id(part)
            elif part:
                normal = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                if self.whole.pre_tokenizer:
                    yield from (word for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal))
                else:
                    yield normal

    def pre_token(self, word: str) -> str:
        return self.whole.pre_tokenizer.pre_tokenize_str(word)[0][0] if self.whole.pre_tokenizer else word

    def _word(self, word: str) -> bytes:
        """One word of plain lower-case letters."""
        if not word.isascii():
            word = word.translate(self.letters)
        return _packed([*map(_ID, self.closing.tokenize(word))])

    def long_word(self, word: str) -> bytes:
        """Halves, encoded apart and joined."""
        return _packed(self._half(word, closing=True))

    def _half(self, word: str, closing: bool) -> list[int]:
        if len(word) <= PIECE:
            return self.piece(word, closing)
        middle = len(word) // 2
        return self.join(self._half(word[:middle], False), self._half(word[middle:], closing), closing)

    def piece(self, word: str, closing: bool) -> list[int]:
        return [t.id for t in (self.closing if closing else self.inner).tokenize(word)]

    def join(self, left: list[int], right: list[int], closing: bool) -> list[int]:
        """The encoding of both sides' text; ``closing`` if the right side ends the word."""
        width = 2
        while left and right:
            a, b = min(width, len(left)), min(width, len(right))
            ends = closing and b == len(right)
            text = "".join(self.strings[i] for i in left[-a:] + right[:b])
            window = self.piece(text.removesuffix(self.end) if ends else text, ends)
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:-a] + window + right[b:]
            width *= 2
        return left or right

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """Neighbours are joined pairwise until one is left."""
        while len(parts) > 1:
            last = len(parts) - 1
            parts = [
                parts[i] if i == last else self.join(parts[i], parts[i + 1], i + 1 == last)
                for i in range(0, len(parts), 2)
            ]
        return parts[0] if parts else []

    def joined(self, pieces: list[dict]) -> bytes:
        """The ids of a text from its encoded pieces (segment, part, ids), which are in order."""
        words: dict[int, list[list[int]]] = {}
        for p in pieces:
            words.setdefault(p["segment"], []).append(p["ids"])
        return b"".join(_packed(self.join_all(parts)) for _, parts in sorted(words.items()))

    # -- decoding

    def decode(self, ids: np.ndarray) -> str:
        if self.whole.decoder is not None:
            return self.whole.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def _spaced(text: str) -> str:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")


class _Memory(dict):
    """What was made last, in two generations: what is met again moves to the younger one."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 64:
                return value
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


_ID = attrgetter("id")
_FEW = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    return _FEW[len(ids)](*ids) if len(ids) < 32 else struct.pack(f"<{len(ids)}I", *ids)


_CODECS: dict[int, Codec] = {}


def codec(vocabulary: Broadcast) -> Codec:
    """The worker's codec of a broadcast vocabulary; made once in a process."""
    begin("bpe", _CODECS.clear)
    text = vocabulary.value
    key = hash(text)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(text)
        give_back()  # reading the file takes as much again as what is kept
    return _CODECS[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file for all workers; its size is checked."""
    with open(path, encoding="utf-8") as file:
        text = file.read(VOCABULARY_BYTES + 1)
    if len(text) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} characters")
    return spark.sparkContext.broadcast(text)


def _lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(encoded))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def encode_column(text: Column, vocabulary: Broadcast) -> Column:
    """Token ids of whole texts, each within one task; null is as empty."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        one = codec(vocabulary)
        return _lists([one.encode(t) for t in texts.to_pylist()])

    return encoded.asNondeterministic()(text)  # else Spark may run it once for each use


def encode(
    df: DataFrame, vocabulary: Broadcast, text: str = "text", ids: str = "ids", long: int = LONG
) -> DataFrame:
    """``df`` with the token ids of each text as ``array<int>``; a column of that name is replaced.

    The ids are those of the tokenizers library without added start and end tokens, truncation or padding.  A null
    or empty text has no ids.  Repeated rows are encoded as often as they are there.
    """
    df = df.drop(ids) if ids != text else df
    is_long = F.coalesce(F.length(text), F.lit(0)) > long
    short = df.filter(~is_long).withColumn(ids, encode_column(F.col(text), vocabulary))
    return short.unionByName(_dealt(df.filter(is_long), vocabulary, text, ids))


def _dealt(df: DataFrame, vocabulary: Broadcast, text: str, ids: str) -> DataFrame:
    """Long texts: pieces are encoded as rows of their own, joins are made where a text's ids meet."""
    pieces = temporary("pieces")

    @F.arrow_udf("array<int>")
    def joined(texts: pa.Array) -> pa.Array:
        one = codec(vocabulary)
        return _lists([one.joined(t.as_py()) for t in texts])

    return encoded_pieces(df, vocabulary, text, pieces).withColumn(ids, joined(F.col(pieces))).drop(pieces)


def encoded_pieces(df: DataFrame, vocabulary: Broadcast, text: str, pieces: str) -> DataFrame:
    """``df`` with the encoded pieces of each text in order, for ``Codec.joined``; a text without pieces has no row."""
    row, piece = temporary("row"), temporary("piece")
    keyed = df.withColumn(row, F.monotonically_increasing_id())

    @F.arrow_udf("array<struct<segment:int,part:int,closing:boolean,text:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        one = codec(vocabulary)
        return pa.array(
            [list(_segments(one, t)) for t in texts.to_pylist()],
            pa.list_(
                pa.struct(
                    [("segment", pa.int32()), ("part", pa.int32()), ("closing", pa.bool_()), ("text", pa.string())]
                )
            ),
        )

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array, parts: pa.Array, closing: pa.Array) -> pa.Array:
        one = codec(vocabulary)
        return _lists(
            [
                one.encode(t) if part < 0 else _packed(one.piece(t, last))
                for t, part, last in zip(texts.to_pylist(), parts.to_pylist(), closing.to_pylist(), strict=True)
            ]
        )

    dealt = (
        keyed.select(row, F.explode(cut.asNondeterministic()(F.col(text))).alias(piece))
        .select(row, f"{piece}.*")
        .repartition(row, "segment", "part")
        .select(row, "segment", "part", encoded.asNondeterministic()("text", "part", "closing").alias("ids"))
    )
    whole = dealt.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("segment", "part", "ids"))).alias(pieces))
    return keyed.join(whole, row).drop(row)


def _segments(one: Codec, text: str) -> Iterator[dict]:
    """Runs of whole units, and the pieces of units that are too long for one."""
    segment, start, n = 0, 0, len(text)
    text = _spaced(text)
    while start < n:
        end = text.rfind(" ", start, start + 8 * PIECE)
        if n - start <= 8 * PIECE:
            end = n
        if end > start:
            yield {"segment": segment, "part": -1, "closing": True, "text": text[start:end]}
            segment, start = segment + 1, end
            continue
        end = text.find(" ", start + 1)
        end = n if end < 0 else end
        for word in one.pre_tokens(text[start:end].strip(" ")):
            if isinstance(word, int):
                yield {"segment": segment, "part": -1, "closing": True, "text": one.strings[word]}
            else:
                for part, at in enumerate(range(0, len(word), PIECE)):
                    yield {
                        "segment": segment,
                        "part": part,
                        "closing": at + PIECE >= len(word),
                        "text": word[at : at + PIECE],
                    }
            segment += 1
        start = end


def decode(df: DataFrame, vocabulary: Broadcast, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids, special tokens kept.  Null ids count as none, an empty text."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        one = codec(vocabulary)
        lists = lists.fill_null([]) if lists.null_count else lists
        values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        return pa.array([one.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])], pa.string())

    return df.withColumn(text, decoded(F.col(ids)))
