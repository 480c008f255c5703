"""Token-ID / binary output: Arrow stream files of equal-length sequences.

Documents are range partitioned and sorted by doc_id (null first, ties by
text). Each task encodes its documents, ends each with an end id, and writes
one file: an Arrow IPC stream whose batches hold ``input_ids`` (fixed-size list
of unsigned integers) and ``mask`` (fixed-size list of booleans, false only
where the file's last sequence is filled up). Files in order of their partition
hold all ids in doc_id order. Every batch but the last has the same number of
sequences, so id ``i`` of a file lies in a known batch at a known place and a
memory-mapped file is read there without copying or parsing what lies before.

An index table names file, first id and number of ids of each document. It is
written by Spark's commit protocol and names only files of tasks that
succeeded; a task that runs again writes a file of another name.

Local paths and what ``pyarrow.fs`` opens by URI (hdfs, s3, gs) can hold the
files; the folder must be one that all executors share.

Defined results: a null or empty text is the end id alone; documents without
doc_id come first; repeated rows are encoded each; an empty table gives no
file. Further columns are left out.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyarrow.compute import take
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import give_back, shared_path, small_batches, with_before

SEQUENCE = 2048
SEQUENCES_A_BATCH = 64
END_ID = 2
INDEX = "part int, file string, doc_id long, first long, n_tokens long"


class _Kept(dict):
    """ids of words; ``most`` words are kept, none longer than ``longest``."""

    def __init__(self, of: Callable[[Any], bytes], most: int, longest: int = 64) -> None:
        super().__init__()
        self.of, self.most, self.longest = of, most, longest

    def __missing__(self, word: str | bytes) -> bytes:
        ids = self.of(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class _Known:
    """ids of words as two Arrow columns, those of the latest texts first; ``most``
    words are known, none longer than ``longest`` bytes."""

    def __init__(self, of: Callable[[pa.Array], pa.Array], most: int, longest: int = 64) -> None:
        self.of, self.most, self.longest = of, most, longest
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def __len__(self) -> int:
        return len(self.words)

    def of_each(self, words: pa.Array) -> pa.Array:
        """ids of ``words``, each there once; ``of`` is asked for all unknown ones together."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        pool = pa.concat_arrays([self.ids, self.of(new)])
        place = at.to_numpy(zero_copy_only=False)  # with nulls: floats, exact up to 2**53
        unknown = np.isnan(place)
        place = np.where(unknown, len(self) + np.cumsum(unknown) - 1, place).astype("i8")
        idle = np.ones(len(self), bool)
        idle[place[~unknown]] = False
        short = pc.less_equal(pc.binary_length(words), self.longest).to_numpy(zero_copy_only=False)
        stay = np.concatenate([place[short], np.flatnonzero(idle)])[: self.most]
        self.words, self.ids, got = take(pa.concat_arrays([self.words, new]), stay), take(pool, stay), take(pool, place)
        return got


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers; an ``array`` of few ids is made in half
    the time of a numpy one."""
    if len(ids) < 64 and sys.byteorder == "little":
        return array("I", ids).tobytes()
    return np.array(ids, "<u4").tobytes()


def byte_letters() -> dict[int, str]:
    """Letters of Latin-1 beyond ASCII as byte-level BPE spells their UTF-8
    bytes: printable bytes stand for themselves, the others for the code points
    from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    spelled = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class TextEncoder:
    """ids of whole texts as bytes of little-endian unsigned 32-bit integers.

    With ``by_word``, the tokenizer sees each word (what stands between ASCII
    white space) once and its ids are kept: right for tokenizers that drop white
    space and never join across it. Words of Latin letters, with or without
    marks behind them, go straight to the tokenizer's model, lower-cased and
    spelled as its byte-level step does, if that gives the tokenizer's own ids
    for ``PROBES``. The kept words are bounded.

    ``encode_all`` does the same by column: the distinct words of a batch of texts
    are looked up, and the unknown ones encoded, ``AT_ONCE`` in a call.
    """

    MOST_WORDS, AT_ONCE = 200_000, 1_000
    PROBES = ("the", "The,", "ÉTÉ&&&", "straße.", "thwhsh", "ÿ", "a", "ñandú|", "ÀÖØÞ!!")
    LETTERS, MARKS = "a-zA-ZÀ-ÖØ-öø-ÿ", ".,!|*$%&#?:;"
    _WORD = re.compile(f"([{LETTERS}]+)([{MARKS}]*)")

    def __init__(self, path: str, by_word: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.spelling, self.model = byte_letters(), self.tokenizer.model
        self.stems = _Kept(self._stem, self.MOST_WORDS)
        self.marks = _Kept(self._raw, self.MOST_WORDS // 100)
        self.letters = Tokenizer(self.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab, suffix = self.tokenizer.get_vocab(), getattr(self.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True
        self.known_stems, self.known_words = _Known(self._of_stems, self.MOST_WORDS), _Known(self._of_words, self.MOST_WORDS)
        self.direct = by_word and all(self._word(w) == self._raw(w) for w in self.PROBES)
        self.direct = self.direct and list(self.encode_all(pa.array(self.PROBES))) == list(map(self._raw, self.PROBES))
        one = self._word if self.direct else self._raw
        self.kept = _Kept(lambda word: one(word.decode()), self.MOST_WORDS)  # by UTF-8, which is split faster than text

    def _raw(self, text: str) -> bytes:
        return id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _stem(self, stem: str) -> bytes:
        spelled = stem if stem.isascii() else stem.translate(self.spelling)
        return id_bytes([t.id for t in self.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        parts = self._WORD.fullmatch(word)
        if not parts:
            return self._raw(word)
        stem, marks = parts.groups()
        return self.stems[stem.lower()] + (self.marks[marks] if marks else b"")

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._raw(text)
        return b"".join(map(self.kept.__getitem__, text.encode().split()))  # bytes split at ASCII white space only

    def _of_words(self, words: pa.Array) -> pa.Array:
        parts = [words.slice(at, self.AT_ONCE).to_pylist() for at in range(0, len(words), self.AT_ONCE)]
        encoded = (self.tokenizer.encode_batch_fast(part, add_special_tokens=False) for part in parts)
        return pa.array((id_bytes(e.ids) for some in encoded for e in some), pa.large_binary())

    def _of_stems(self, stems: pa.Array) -> pa.Array:
        """Stems joined by spaces, told apart by the ids that end a word."""
        out = [pa.array([], pa.large_binary())]
        for at in range(0, len(stems), self.AT_ONCE):
            some = stems.slice(at, self.AT_ONCE)
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), pa.scalar(" ", some.type))[0].as_py()
            ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some):
                offsets = np.concatenate([[0], ends * 4]).astype("i8")
                out.append(pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())]))
            else:  # a model that does not mark the ends
                out.append(self._of_words(some))
        return pa.concat_arrays(out)

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of each text of a column; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.by_word:
            yield from map(self._raw, texts.to_pylist())
            return
        split = pc.ascii_split_whitespace(texts)
        each = split.flatten().dictionary_encode()
        words = each.dictionary
        stems = pc.utf8_rtrim(words, self.MARKS)
        plain = pc.match_substring_regex(stems, f"^[{self.LETTERS}]+$") if self.direct else pa.array(np.zeros(len(words), bool))
        others = self.known_words.of_each(words.filter(pc.invert(plain)))
        stems = pc.utf8_lower(stems.filter(plain)).dictionary_encode()
        marks = pc.replace_substring_regex(words.filter(plain), f"^[{self.LETTERS}]+", "").dictionary_encode()
        stem_ids = take(self.known_stems.of_each(stems.dictionary), stems.indices)
        mark_ids = take(self.known_words.of_each(marks.dictionary), marks.indices)
        of_plain = pc.binary_join_element_wise(stem_ids, mark_ids, pa.scalar(b"", pa.large_binary()))
        is_plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(is_plain, np.cumsum(is_plain) - 1, len(of_plain) + np.cumsum(~is_plain) - 1)
        ids = take(pa.concat_arrays([of_plain, others]), place[each.indices.to_numpy()])
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, "i8", len(ids) + 1)[split.offsets.to_numpy()].tolist()
        flat = memoryview(data or b"")
        for first, end in zip(at, at[1:]):
            yield bytes(flat[first:end])


_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, by_word: bool) -> TextEncoder:
    """One encoder for each Python worker, kept between its tasks."""
    if (path, by_word) not in _ENCODERS:
        _ENCODERS[path, by_word] = TextEncoder(path, by_word)
    return _ENCODERS[path, by_word]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class SequenceFile:
    """Writer of one file of equal-length sequences."""

    def __init__(self, uri: str, sequence: int, sequences_a_batch: int, dtype: str) -> None:
        store, path = filesystem(uri)
        store.create_dir(os.path.dirname(path), recursive=True)
        self.sequence, self.full, self.dtype = sequence, sequence * sequences_a_batch, np.dtype(dtype)
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema(
            [("input_ids", pa.list_(pa.field("item", kind, False), sequence)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), sequence))],
            metadata={"sequence": str(sequence), "sequences_a_batch": str(sequences_a_batch)},
        )
        self.out = store.open_output_stream(path)
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n = self.held = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n += len(ids)
        self.held += len(ids)
        if self.held >= self.full:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.full * self.full
            for at in range(0, whole, self.full):
                self._batch(flat[at : at + self.full], self.full)
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _batch(self, ids: np.ndarray, real: int) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids.astype(self.dtype), np.arange(len(ids)) < real), self.schema)]
        self.stream.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.concatenate(self.waiting)
            self._batch(np.pad(ids, (0, -len(ids) % self.sequence)), len(ids))
        self.stream.close()
        self.out.close()


class SequenceReader:
    """Random access to the ids of one file."""

    def __init__(self, uri: str) -> None:
        store, path = filesystem(uri)
        local = isinstance(store, pafs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else store.open_input_file(path)
        stream = pa.ipc.open_stream(self.source)
        meta = stream.schema.metadata
        self.sequence = int(meta[b"sequence"])
        self.full = self.sequence * int(meta[b"sequences_a_batch"])
        self.batches = list(stream)

    def pieces(self, first: int, n: int) -> Iterator[np.ndarray]:
        """Views of ids ``first`` to ``first + n``, one for each batch they lie in."""
        while n > 0:
            k, at = divmod(first, self.full)
            lists = self.batches[k].column(0)
            got = lists.values.to_numpy(zero_copy_only=True)[at : at + n]
            yield got
            first, n = first + len(got), n - len(got)

    def masked(self) -> int:
        """Number of real ids, by the masks."""
        return sum(b.column(1).values.true_count for b in self.batches)

    def close(self) -> None:
        self.batches = []
        self.source.close()


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID, by_word: bool = False, sequence: int = SEQUENCE, sequences_a_batch: int = SEQUENCES_A_BATCH, dtype: str = "uint16") -> DataFrame:
    """Write the files below ``out`` and return their index (also a table there).
    ``dtype`` must hold the largest id."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, end = TaskContext.get().partitionId(), None, np.array([end_id], "<u4").tobytes()
        enc = encoder(tokenizer, by_word)
        for b in batches:
            rows = []
            for doc_id, encoded in zip(b["doc_id"].to_pylist(), enc.encode_all(b["text"])):
                if file is None:
                    uri = f"{out}/files/part-{part:06d}-{uuid.uuid4().hex}.arrows"
                    file = SequenceFile(uri, sequence, sequences_a_batch, dtype)
                ids = np.frombuffer(encoded + end, "<u4")
                if ids.max() > np.iinfo(dtype).max:
                    raise ValueError(f"id {ids.max()} does not fit {dtype}")
                rows.append((part, uri, doc_id, file.n, len(ids)))
                file.add(ids)
            yield pa.record_batch(list(zip(*rows)) or [[]] * len(schema), schema=schema)
        if file:
            file.close()
        give_back()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, INDEX).write.parquet(f"{out}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{out}/index")


def read_token_files(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    each document, its ids read from the files. Rows of the index are read as
    they lie in its own files, so each task opens few token files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for b in batches:
            sums = []
            for uri, first, n in zip(*(b[c].to_pylist() for c in ("file", "first", "n_tokens"))):
                if uri != name:
                    if file:
                        file.close()
                    name, file = uri, SequenceReader(uri)
                crc = 0
                for piece in file.pieces(first, n):
                    crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                sums.append(crc)
            yield pa.record_batch([b["doc_id"], b["start"], b["n_tokens"], pa.array(sums, pa.int64())], schema=schema)

    placed = with_before(index, "part", F.col("n_tokens"), "before").withColumn("start", F.col("before") + F.col("first"))
    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str, **options: object) -> DataFrame:
    """Write all documents below the shared folder and read them back."""
    return read_token_files(write_token_files(docs, shared_path(docs.sparkSession, "tokens"), tokenizer, **options))
