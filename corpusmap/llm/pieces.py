"""SentencePiece encoding and decoding: merges of BPE models, a max-plus parallel scan of unigram models.

The scores of a BPE file rank its merges and don't add up, so such a file is encoded by its merges
(``Merges``); a pair of characters that no piece holds is never merged across, so texts are cut there.

``Pieces`` reads pieces and scores as a unigram lattice: the encoding of a text is the segmentation
with the largest sum of scores. Scores are scaled to whole numbers without rounding, so sums are exact
and grouping them differently changes nothing. A giant text is cut into chunks; each chunk
gives a matrix from the best scores at the last positions before it to those at its own last
positions, in max-plus algebra. Folding the matrices gives every chunk its entry scores; each chunk
then traces back on its own from every exit, and chaining these traces picks the one that counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from corpusmap.llm.common import as_bytes, fresh, slices
from corpusmap.session import cut_lineage

CHUNK = 1 << 16
NEVER = -(10**17)
CACHE = 1 << 18
#: Bytes of text that learn their new words together.
SLICE = 1 << 19
MISSING = object()
RESET = re.compile(r"[^ ] ")
#: Of sentencepiece: how far below the least score an unknown character is.
UNKNOWN_PENALTY = 10


def bytes_of_pieces(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """What each id stands for; nothing for control pieces."""
    out = []
    for i in range(processor.get_piece_size()):
        name = processor.id_to_piece(i)
        if processor.is_byte(i):
            out.append(bytes([int(name[3:5], 16)]))
        else:
            silent = processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)
            out.append(b"" if silent else name.replace("▁", " ").encode())
    return out


def decoded(table: list[bytes], ids) -> str:
    """The text of ids, without the space before it; bytes that are no UTF-8 become U+FFFD."""
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


class Pieces:
    """Pieces of a model with byte fallback, and the best segmentation of strings.

    A space stands for the mark that pieces have in its place; the mark itself, where a text has
    it, goes through the byte pieces, so that decoding is exact.
    """

    def __init__(self, model: bytes):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, tuple[int, int]] = {}
        self.bytes_of = bytes_of_pieces(processor)
        self.byte_ids = [0] * 256
        for i in range(processor.get_piece_size()):
            name = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
            elif self.bytes_of[i]:
                self.ids[name.replace("▁", " ")] = (i, processor.get_score(i))
        self.scale = max(score.as_integer_ratio()[1] for _, score in self.ids.values())
        if self.scale > 1 << 40 or max(abs(score) for _, score in self.ids.values()) * self.scale > 1 << 44:
            raise ValueError("scores of the model are too fine to be summed exactly")
        self.ids = {name: (i, int(score * self.scale)) for name, (i, score) in self.ids.items()}
        least = min(score for _, score in self.ids.values())
        self.unknown = least - UNKNOWN_PENALTY * self.scale
        #: Scores of pieces; beginnings that are no piece themselves have None.
        self.tree: dict[str, int | None] = {name[:i]: None for name in self.ids for i in range(1, len(name))}
        self.tree.update((name, score) for name, (_, score) in self.ids.items())
        self.longest = max(map(len, self.ids))
        names = sorted(self.tree)
        state = {name: i + 1 for i, name in enumerate(names)}
        steps = sorted((state.get(name[:-1], 0) << 21 | ord(name[-1]), i) for name, i in state.items())
        self.steps, self.onto = (np.array(x, "i8") for x in zip(*steps))
        self.piece = np.array([-1] + [self.ids.get(name, (-1, 0))[0] for name in names], "i8")
        self.worth = np.array([0] + [self.ids.get(name, (0, 0))[1] for name in names], "i8")
        self.value = np.zeros(len(self.bytes_of), "i8")
        self.value[[i for i, _ in self.ids.values()]] = [score for _, score in self.ids.values()]
        # a byte piece that begins a character stands for one unknown character
        self.value[[i for b, i in enumerate(self.byte_ids) if not 0x80 <= b < 0xC0]] = self.unknown
        #: Whether a space after another character always starts a piece, and whether no piece has a line break.
        self.breaks = not any(" " in name.lstrip(" ") for name in self.ids)
        self.lines = self.breaks and not any("\n" in name for name in self.ids)
        self.cache: dict[str, bytes] = {}  # ids as 32-bit numbers

    def forward(self, text: str, off: int, entry: list[int]) -> tuple[list[int], list[int]]:
        """Best scores of paths that end at each position after ``off``, and where their last piece starts.

        ``entry[j]`` is the best score at position ``off - j``. Of equal scores the longer last piece wins.
        """
        score, back = [NEVER] * (len(text) + 1), [-1] * (len(text) + 1)
        for j in range(min(len(entry), off + 1)):
            score[off - j] = entry[j]
        get, longest, unknown, size = self.tree.get, self.longest, self.unknown, len(text)
        for start in range(max(0, off + 1 - longest), size):
            base = score[start]
            if base <= NEVER:
                continue
            alone = get(text[start], MISSING)
            if start >= off and (alone is None or alone is MISSING):
                if base + unknown > score[start + 1]:
                    score[start + 1], back[start + 1] = base + unknown, start
            if alone is MISSING:
                continue
            for end in range(start + 1, min(size, start + longest) + 1):
                value = get(text[start:end], MISSING)
                if value is None:
                    continue
                if value is MISSING:
                    break
                if end > off and base + value > score[end]:
                    score[end], back[end] = base + value, start
        return score, back

    def ids_of(self, piece: str) -> tuple[int, ...]:
        found = self.ids.get(piece)
        return (found[0],) if found else tuple(self.byte_ids[b] for b in piece.encode())

    def trace(self, text: str, back: list[int], end: int, off: int) -> tuple[list[int], int]:
        """Ids of the pieces that end after ``off`` on the path to ``end``, and where the path enters."""
        parts = []
        while end > off:
            parts.append(self.ids_of(text[back[end] : end]))
            end = back[end]
        return list(chain.from_iterable(reversed(parts))), end

    def best(self, text: str) -> tuple[int, ...]:
        """Ids of a whole string on its own."""
        return tuple(self.trace(text, self.forward(text, 0, [0])[1], len(text), 0)[0])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, with the space that stands before every text."""
        if not text:
            return np.zeros(0, "i4")
        if not self.breaks:
            return np.array(self.best(" " + text), "i4")
        words = self.words(text)
        self.learn(words)
        return np.frombuffer(self.spelled(words), "i4")

    def spelled(self, words: list[str]) -> bytes:
        """The ids of learnt words, one after the other."""
        return b"".join(map(self.cache.__getitem__, words))

    def words(self, text: str) -> list[str]:
        """Stretches that are segmented on their own, without the one space before each."""
        words = (text.replace("\n", " \n") if self.lines else text).split(" ")
        return list(self._joined(words)) if "" in words else words

    def learn(self, words: list[str]) -> None:
        """Segment the words that the cache lacks; it is emptied when full, so memory stays bounded."""
        if len(self.cache) >= CACHE:
            self.cache = {}
        new = list(set(words).difference(self.cache))
        spelled = []
        for word in new:
            bare = word.lstrip(" ")
            if not bare or self.lines and bare.startswith("\n"):
                spelled.append(word)  # the spaces of the key are all there are
            else:
                spelled.append(" " + word)
        short = [i for i, text in enumerate(spelled) if len(text) <= 64]
        self.cache.update(zip((new[i] for i in short), self.best_of([spelled[i] for i in short])))
        for i, text in enumerate(spelled):
            if len(text) > 64:
                self.cache[new[i]] = np.array(self.best(text), "i4").tobytes()

    def best_of(self, texts: list[str]) -> list[bytes]:
        """Ids of many short strings: all start positions walk the tree of pieces together, then all
        strings take each step of the search for the best path together."""
        if not texts:
            return []
        length = np.array([len(t) for t in texts])
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "u4").astype("i8")
        base = np.cumsum(length) - length
        word = np.repeat(np.arange(len(texts)), length)
        place = np.arange(len(points)) - base[word]
        rest, slot = length[word] - place, np.arange(len(points)) + word  # one slot more than characters per string
        live, state = np.arange(len(points)), np.zeros(len(points), "i8")
        start, width, piece, worth = [], [], [], []
        for n in range(1, self.longest + 1):
            live = live[rest[live] >= n]
            key = state[live] << 21 | points[live + n - 1]
            at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            hit = self.steps[at] == key
            live = live[hit]
            state[live] = self.onto[at[hit]]
            found = live[self.piece[state[live]] >= 0]
            start.append(found)
            width.append(np.full(len(found), n))
            piece.append(self.piece[state[found]])
            worth.append(self.worth[state[found]])
            if n == 1:
                alone = np.ones(len(points), "?")
                alone[found] = False
                unknown = np.flatnonzero(alone)
                start.append(unknown)
                width.append(np.ones(len(unknown), "i8"))
                piece.append(-1 - points[unknown])
                worth.append(np.full(len(unknown), self.unknown))
            if not len(live):
                break
        start, width, piece, worth = (np.concatenate(x) for x in (start, width, piece, worth))
        order = np.argsort(place[start].astype("i2"), kind="stable")
        start, width, piece, worth = start[order], width[order], piece[order], worth[order]
        begin = slot[start]
        score, came = np.full(len(points) + len(texts), NEVER, "i8"), np.zeros(len(points) + len(texts), "i8")
        score[base + np.arange(len(texts))] = 0
        cuts = np.searchsorted(place[start], np.arange(length.max() + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            value, end = score[begin[a:b]] + worth[a:b], begin[a:b] + width[a:b]
            better = np.flatnonzero(value > score[end])
            score[end[better]] = value[better]
            came[end[better]] = a + better
        now, owner = base + np.arange(len(texts)) + length, np.arange(len(texts))
        owners, chosen = [], []
        first = base + np.arange(len(texts))
        while len(owner):
            step = came[now]
            owners.append(owner)
            chosen.append(piece[step])
            now = now - width[step]
            more = now > first[owner]
            now, owner = now[more], owner[more]
        owners, chosen = np.concatenate(owners[::-1]), np.concatenate(chosen[::-1])
        order = np.argsort(owners, kind="stable")
        ids, stops = chosen[order].astype("i4").tobytes(), (4 * np.cumsum(np.bincount(owners, minlength=len(texts)))).tolist()
        out = [ids[a:b] for a, b in zip([0, *stops], stops)]
        for i in np.unique(owners[chosen < 0]).tolist():
            parts = ((x,) if x >= 0 else (self.byte_ids[b] for b in chr(-1 - x).encode()) for x in np.frombuffer(out[i], "i4").tolist())
            out[i] = np.fromiter(chain.from_iterable(parts), "i4").tobytes()
        return out

    def _joined(self, words: list[str]) -> Iterator[str]:
        """Runs of spaces go to the word they precede, under a key of their own."""
        spaces = 0
        for word in words:
            if word:
                yield " " * spaces + word if spaces else word
                spaces = 0
            else:
                spaces += 1
        if spaces:
            yield " " * spaces

    def decode(self, ids) -> str:
        return decoded(self.bytes_of, ids)

    def resets(self, text: str, off: int) -> tuple[int, int] | None:
        """The first and last position, after ``off`` and before the last exits, that every path passes."""
        if not self.breaks:
            return None
        stop = len(text) - self.longest
        first = next((m.start() + 1 for m in RESET.finditer(text, off) if m.start() + 1 <= stop), None)
        if first is None:
            return None
        last = stop
        while not (text[last] == " " and text[last - 1] != " "):
            last -= 1
        return first, last

    def middle(self, text: str) -> list[int]:
        """Ids between two resets."""
        return self.encode(text[1:]).tolist() if text else []

    def matrix(self, text: str, off: int) -> np.ndarray:
        """Best score from each entry position to each of the last positions of a chunk."""
        size, out, found = self.longest, np.full((self.longest, self.longest), NEVER, "i8"), self.resets(text, off)
        if found:
            first, last = found
            inner = int(self.value[self.middle(text[first:last])].sum())
            tail = self.forward(text[last:], 0, [0])[0]
        for j in range(min(size, off + 1)):
            entry = [NEVER] * size
            entry[j] = 0
            score = self.forward(text[: first if found else len(text)], off, entry)[0]
            for k in range(min(size, len(text) + 1)):
                if not found:
                    out[j, k] = score[len(text) - k]
                elif score[first] > NEVER and tail[len(text) - last - k] > NEVER:
                    out[j, k] = score[first] + inner + tail[len(text) - last - k]
        return out

    def ways(self, text: str, off: int, entry: list[int]) -> list[int]:
        """For each exit, counted back from the end of a chunk, the entry that its best path comes from."""
        found = self.resets(text, off)
        if found:
            back = self.forward(text[: found[0]], off, entry)[1]
            return [off - self.trace(text, back, found[0], off)[1]] * self.longest
        score, back = self.forward(text, off, entry)
        exits = range(min(self.longest, len(text) - off))
        own = [off - self.trace(text, back, len(text) - k, off)[1] if score[len(text) - k] > NEVER else -1 for k in exits]
        # a chunk shorter than a piece: exits before it are entries, moved on
        return own + [k - (len(text) - off) for k in range(len(own), self.longest)]

    def spell(self, text: str, off: int, entry: list[int], leave: int) -> list[int]:
        """Ids of the pieces that end in a chunk, on the best path to one exit."""
        if leave >= len(text) - off:
            return []
        found = self.resets(text, off)
        if not found:
            return self.trace(text, self.forward(text, off, entry)[1], len(text) - leave, off)[0]
        first, last = found
        head = self.trace(text, self.forward(text[:first], off, entry)[1], first, off)[0]
        tail = self.trace(text[last:], self.forward(text[last:], 0, [0])[1], len(text) - last - leave, 0)[0]
        return head + self.middle(text[first:last]) + tail


class Merges(Pieces):
    """Pieces of a BPE model, and the segmentation of strings by its merges: the ids of the library.

    The mark itself, where a text has it, goes through the byte pieces; the library would take it for a space.
    """

    def __init__(self, model: bytes):
        super().__init__(model)
        spec = model_pb2.ModelProto()
        spec.ParseFromString(model)
        spec.normalizer_spec.CopyFrom(
            model_pb2.NormalizerSpec(name="identity", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=True)
        )
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.pairs = {name[i : i + 2] for name in self.ids for i in range(len(name) - 1)}
        self.mark = tuple(self.byte_ids[b] for b in "▁".encode())

    def best(self, text: str) -> tuple[int, ...]:
        """Ids of a whole string on its own."""
        out: list[int] = []
        for i, part in enumerate(text.split("▁")):
            out += self.mark if i else ()
            out += self.processor.encode(part) if part else ()
        return tuple(out)

    def best_of(self, texts: list[str]) -> list[bytes]:
        """Ids of many short strings."""
        plain = [t for t in texts if "▁" not in t]
        coded = iter(self.processor.encode(plain, num_threads=1) if plain else [])
        return [np.array(self.best(t) if "▁" in t else next(coded), "i4").tobytes() for t in texts]

    def cuts(self, text: str, chunk: int) -> Iterator[str]:
        """The text in parts of about ``chunk`` characters, or as many more as hang together."""
        start = 0
        while start < len(text):
            end = min(start + chunk, len(text))
            while end < len(text) and text[end - 1 : end + 1] in self.pairs:
                end += 1
            yield text[start:end]
            start = end


def reader_of(model: bytes) -> type[Pieces]:
    """How the ids of a model are found."""
    spec = model_pb2.ModelProto()
    spec.ParseFromString(model)
    kinds = {spec.trainer_spec.BPE: Merges, spec.trainer_spec.UNIGRAM: Pieces}
    if spec.trainer_spec.model_type not in kinds:
        raise ValueError("only BPE and unigram models can be read")
    return kinds[spec.trainer_spec.model_type]


def max_plus(vector: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return np.maximum((vector[:, None] + matrix).max(axis=0), NEVER)


def load(spark, model_file: str) -> bytes:
    """A model of bounded size, through Spark's own reader, so it may lie in any store; else from the driver's disk."""
    import os

    if os.path.isfile(model_file):
        with open(model_file, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(model_file).select("content").first()[0])


def encode_column(spark, model: bytes, text: Column, reader: type[Pieces] = Pieces) -> Column:
    """``ids, exact`` of texts that one task can take whole; ``exact`` says whether decoding gives the text back.

    Decoding in the same pass spares a second way of all ids through a worker.
    """
    held = spark.sparkContext.broadcast(model)

    @arrow_udf("struct<ids:array<int>,exact:boolean>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = reader(held.value)
        for batch in batches:
            parts, offsets, exact = [], [0], []
            for first, last in slices(as_bytes(batch), SLICE):
                texts = batch.slice(first, last - first).to_pylist()
                if pieces.breaks:  # all new words of a slice in one go
                    split = [pieces.words(t) if t else [] for t in texts]
                    pieces.learn(list(chain.from_iterable(split)))
                    coded = [pieces.spelled(words) for words in split]
                else:
                    coded = [pieces.encode(t or "").tobytes() for t in texts]
                for text, part in zip(texts, coded):
                    offsets.append(offsets[-1] + len(part) // 4)
                    exact.append(text is None or pieces.decode(np.frombuffer(part, "i4").tolist()) == text)
                parts.append(b"".join(coded))
            null = np.append(np.asarray(batch.is_null()), False) if batch.null_count else None
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=null), pa.array(np.frombuffer(b"".join(parts), "i4"), pa.int32()))
            yield pa.StructArray.from_arrays([ids, pa.array(exact, pa.bool_())], ["ids", "exact"])

    return encode(text.cast("string"))


def decode_column(spark, model: bytes, ids: Column) -> Column:
    """The texts of arrays of ids; null stays null, nulls within an array are skipped."""
    held = spark.sparkContext.broadcast(model)

    @arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = bytes_of_pieces(sentencepiece.SentencePieceProcessor(model_proto=held.value))
        for batch in batches:
            yield pa.array([decoded(table, row.values.drop_null().to_numpy().tolist()) if row.is_valid else None for row in batch], pa.string())

    return decode(ids)


def encode(
    docs: DataFrame, model: bytes, text_col: str = "text", out_col: str = "token_ids", chunk: int = CHUNK, exact_col: str | None = None,
    reader: type[Pieces] = Pieces,
) -> DataFrame:
    """``docs`` with the ids of every whole text, and on request whether decoding gives it back.

    Texts of more than ``chunk`` characters go through the scan, or in parts through the merges, the others whole through one task.
    ``reader_of`` names the reader that gives a model's own ids.
    A column named ``out_col`` or ``exact_col`` is replaced, others stay whatever their name.
    Null texts get null, empty ones an empty array; equal texts get equal ids, repeated rows stay, and
    decoding gives back every text exactly.
    """
    spark = docs.sparkSession
    long = F.coalesce(F.char_length(F.col(text_col).cast("string")) > chunk, F.lit(False))
    out, own = fresh("piece_out", docs), [c for c in docs.columns if c not in (out_col, exact_col)]
    short = docs.filter(~long).withColumn(out, encode_column(spark, model, F.col(text_col), reader))
    short = short.select(*own, F.col(f"{out}.ids").alias(out_col), *([F.col(f"{out}.exact").alias(exact_col)] if exact_col else []))
    giant = docs.filter(long)
    if giant.isEmpty():
        return short
    key = F.sha2(F.col(text_col).cast("string"), 256)
    texts = giant.select(key.alias("piece_key"), F.col(text_col).cast("string").alias("text")).dropDuplicates(["piece_key"])
    scanned = (merge_giant if reader is Merges else encode_giant)(texts, model, chunk)
    name, found = fresh("piece_key", docs), fresh("piece_found", docs)
    scanned = scanned.select(F.struct("piece_key", "token_ids").alias(found))
    giant = giant.withColumn(name, key).join(scanned, F.col(name) == F.col(f"{found}.piece_key"))
    ids = F.col(f"{found}.token_ids")
    exact = [decode_column(spark, model, ids).eqNullSafe(F.col(text_col).cast("string")).alias(exact_col)] if exact_col else []
    return short.unionByName(giant.select(*own, ids.alias(out_col), *exact))


def merge_giant(texts: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """``piece_key, token_ids`` for ``piece_key, text`` by the merges of a model, part by part; ``piece_key`` is unique."""
    held = texts.sparkSession.sparkContext.broadcast(model)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Merges(held.value)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k, part in enumerate(pieces.cuts(" " + text.as_py(), chunk)):
                    yield pa.record_batch([pa.array([key], pa.string()), pa.array([k], pa.int64()), pa.array([part], pa.string())], ["piece_key", "k", "chunk"])

    chunks = cut_lineage(texts.select("piece_key", "text").mapInArrow(cut, "piece_key string, k bigint, chunk string"))

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Merges(held.value)
        for b in batches:
            yield pd.DataFrame({"piece_key": b.piece_key, "k": b.k, "ids": [list(pieces.best(part)) for part in b["chunk"]]})

    width = F.pmod(F.xxhash64("piece_key", "k"), F.lit(1 << 20))  # parts of one text over all tasks
    spelled = chunks.repartition(width).mapInPandas(spell, "piece_key string, k bigint, ids array<int>")
    whole = spelled.groupBy("piece_key").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return whole.select("piece_key", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("token_ids"))


def encode_giant(texts: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """``piece_key, token_ids`` for ``piece_key, text``, chunk by chunk; ``piece_key`` is unique."""
    held = texts.sparkSession.sparkContext.broadcast(model)
    longest = Pieces(model).longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = " " + text.as_py()
                for k, start in enumerate(range(0, len(text), chunk)):
                    before = min(longest - 1, start)
                    row = [[key], [k], [before], [text[start - before : start + chunk]]]
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(row, (pa.string(), pa.int64(), pa.int32(), pa.string()))], ["piece_key", "k", "off", "chunk"])

    chunks = cut_lineage(texts.select("piece_key", "text").mapInArrow(cut, "piece_key string, k bigint, off int, chunk string"))
    width = F.pmod(F.xxhash64("piece_key", "k"), F.lit(1 << 20))  # chunks of one text over all tasks
    dealt = chunks.repartition(width)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(held.value)
        for b in batches:
            yield pd.DataFrame({"piece_key": b.piece_key, "k": b.k, "m": [pieces.matrix(t, off).tobytes() for t, off in zip(b["chunk"], b.off)]})

    def entries(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("k")
        now = np.full(longest, NEVER, "i8")
        now[0] = 0
        out = []
        for m in b.m:
            out.append(now.tolist())
            now = max_plus(now, np.frombuffer(m, "i8").reshape(longest, longest))
            now = np.where(now > NEVER, now - now.max(), NEVER)  # only differences count; sums stay small
        return pd.DataFrame({"piece_key": b.piece_key, "k": b.k, "entry": out})

    folded = dealt.mapInPandas(matrices, "piece_key string, k bigint, m binary").groupBy("piece_key").applyInPandas(
        entries, "piece_key string, k bigint, entry array<bigint>"
    )
    ready = cut_lineage(chunks.join(folded, ["piece_key", "k"]))

    def ways(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(held.value)
        for b in batches:
            out = [pieces.ways(t, off, list(map(int, entry))) for t, off, entry in zip(b["chunk"], b.off, b.entry)]
            yield pd.DataFrame({"piece_key": b.piece_key, "k": b.k, "way": out})

    def exits(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("k", ascending=False)
        now, out = 0, []
        for way in b.way:
            out.append(now)
            now = int(way[now])
        return pd.DataFrame({"piece_key": b.piece_key, "k": b.k, "leave": out})

    left = ready.mapInPandas(ways, "piece_key string, k bigint, way array<int>").groupBy("piece_key").applyInPandas(
        exits, "piece_key string, k bigint, leave int"
    )

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(held.value)
        for b in batches:
            out = [pieces.spell(t, off, list(map(int, entry)), leave) for t, off, entry, leave in zip(b["chunk"], b.off, b.entry, b.leave)]
            yield pd.DataFrame({"piece_key": b.piece_key, "k": b.k, "ids": out})

    spelled = ready.join(left, ["piece_key", "k"]).mapInPandas(spell, "piece_key string, k bigint, ids array<int>")
    whole = spelled.groupBy("piece_key").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return whole.select("piece_key", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("token_ids"))
