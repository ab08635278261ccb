"""Removal of long repeated byte strings, by suffix sorting of shards.

Every byte covered by a string of ``length`` bytes that also starts elsewhere,
in any text or the same one, goes; strings are judged on the input.

1. In each window of ``length`` bytes the gram of least hash (of about a third of
   the window) is its anchor.  Equal windows have equal anchors at equal places,
   so windows need only be compared with those of the same anchor.  Neighbouring
   windows with one anchor are a segment.
2. Only anchors that occur twice matter.  Segments of one anchor that are equal
   as a whole repeat in all their windows; one of them stands for them.
3. Distinct segments of repeated anchors are cut into strips of ``STRIP``
   neighbouring windows, counted from the anchor.  All windows of a strip hold
   the same core of ``length - STRIP + 1`` bytes, so only strips with a core that
   occurs twice are looked at further; again equal strips repeat as a whole.
4. The texts of distinct strips of one core are dealt by core to shards of about
   ``SHARD`` bytes.  Each shard's suffixes are sorted by external induced sorting (see
   ``induced_sort``), which gives what each has in common with its neighbours: a
   window repeats if that is ``length`` bytes or more.
5. A core with more than ``WIDE`` strips (the edge of a passage that very many
   texts share) isn't brought together: its windows are dealt out by their own
   digests, and counted.

Spans are then collected per distinct text, and texts are cut once.  Anchors and
segments are 64-bit hashes; two segments are taken for equal only if anchor,
digest and length agree (128 bits).

Asked for ``words``, it also counts the words of strings of that many words which stand in
another row as well.  Such a passage can be shorter than ``length`` bytes; its bytes stay.  Steps
1 and 2 are taken over word hashes (see ``tokens``; A-Z count as a-z, white space doesn't count)
and rows instead of places; the windows of what is left are dealt out by their own digests, as in 5.

Defined results: a null text counts as empty; a null id is passed through;
repeated rows and equal texts are copies of each other; texts shorter than
``length`` lose nothing; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotrend.llm.induced_sort import Sorter
from repotrend.llm.scratch import Scratch
from repotrend.llm.tokens import chunks, mix, text_buffer, word_hashes

LENGTH = 400
STRIP = 32
SHARD = 2 << 20  # sorting takes about 75 bytes of memory for each
WIDE = 256
_BASE = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the ``gram`` (a power of two) bytes, or hashes of words, from each place on."""
    out, size = _VALUE[data] if data.dtype == np.uint8 else data, 1
    while size < gram:
        out = out[:-size] * np.uint64(pow(_BASE, size, 2**64)) + out[size:]
        size *= 2
    return mix(out)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row: of two running minima over blocks of that width."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


_PLACE = 26  # bits of a key that hold a place; longer runs of text are cut with an overlap


def _runs(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first windows, numbers of windows, anchors' places, anchor hashes) of the runs of windows with one anchor."""
    most = 1 << _PLACE
    for at in range(0, len(data) - length + 1, most - length + 1):
        part = data[at : at + most]
        grams = _grams(part, gram)
        low = np.uint64(most - 1)
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_least(keys, length - gram + 1) & low).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        yield starts + at, np.diff(np.append(starts, len(anchor))), anchor[starts] + at, grams[anchor[starts]]


def gram_size(length: int) -> int:
    """The power of two nearest below a third of the window."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def segments(rows: DataFrame, length: int, words: bool = False) -> DataFrame:
    """(start, windows, place, anchor, seg) after the columns of (id, doc, ..., text) but the text; place: of the anchor, from the start.

    Counted in bytes or in words.
    """
    keys = [c for c in rows.columns if c != "text"]
    kinds = {"start": pa.int64(), "windows": pa.int32(), "place": pa.int32(), "anchor": pa.int64(), "seg": pa.int64()}
    gram = gram_size(length // 2 if words else length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for row, end in chunks(offsets):
                bounds = offsets[row : end + 1]
                part, bounds = word_hashes(data, bounds) if words else (data[bounds[0] : bounds[-1]], bounds - bounds[0])
                if len(part) < length:
                    continue
                rows_of, columns, unit = [], [[] for _ in kinds], part.itemsize
                for starts, sizes, places, anchors in _runs(part, length, gram):
                    # Windows that reach into the next text are none; a run may be of several texts.
                    cut = np.unique(np.concatenate((starts, bounds[(bounds > starts[0]) & (bounds < starts[-1] + sizes[-1])])))
                    own = np.searchsorted(starts, cut, "right") - 1
                    stop = np.append(cut[1:], starts[-1] + sizes[-1])
                    text = np.searchsorted(bounds, cut, "right") - 1
                    stop = np.minimum(stop, bounds[text + 1] - length + 1)
                    ok = np.flatnonzero(stop > cut)
                    raw = part.tobytes() if len(ok) else b""
                    digest = [xxhash.xxh3_64_intdigest(raw[unit * i : unit * (j + length - 1)]) for i, j in zip(cut[ok].tolist(), stop[ok].tolist(), strict=True)]
                    rows_of.append(row + text[ok])
                    found = (cut[ok] - bounds[text[ok]], (stop - cut)[ok], places[own[ok]] - cut[ok],
                             anchors[own[ok]].view(np.int64), np.array(digest, np.uint64).view(np.int64))
                    for column, values in zip(columns, found, strict=True):
                        column.append(values)
                if rows_of:
                    which = pa.array(np.concatenate(rows_of))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(which) for c in keys),
                         *(pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds.values(), strict=True))], [*keys, *kinds])

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
    return rows.mapInArrow(run, f"{kept}, start long, windows int, place int, anchor long, seg long")


def _contents(wanted: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """(id, doc, start, windows, place, anchor, unique, content) of the wanted segments."""
    parts = F.collect_list(F.struct("start", "windows", "place", "anchor", "unique")).alias("parts")  # at most a segment a byte of one text
    asked = wanted.groupBy("id", "doc").agg(parts)
    met = asked.join(rows, asked.id.eqNullSafe(rows.id) & (asked.doc == rows.doc)).select(asked.id, asked.doc, "parts", "text")
    kinds = {"start": pa.int64(), "windows": pa.int32(), "place": pa.int32(), "anchor": pa.int64(), "unique": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, doc, cuts, text in zip(*(batch.column(c) for c in ("id", "doc", "parts", "text")), strict=True):
                raw, cuts = text.as_py().encode(), cuts.as_py()
                n = len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id_.as_py()] * n, pa.int64()), pa.array([doc.as_py()] * n, pa.binary()),
                     *(pa.array([c[k] for c in cuts], t) for k, t in kinds.items()),
                     pa.array([raw[c["start"] : c["start"] + c["windows"] + length - 1] for c in cuts], pa.binary())],
                    ["id", "doc", *kinds, "content"])

    return met.mapInArrow(run, "id long, doc binary, start long, windows int, place int, anchor long, unique boolean, content binary")


def _strips(contents: DataFrame, length: int, strip: int) -> DataFrame:
    """(id, doc, start, anchor, unique, off, n, core, seg): runs of windows of a segment with one core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, off, size, core, seg = [], [], [], [], []
            for k, (windows, place, content) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("windows", "place", "content")), strict=True)):
                at = 0
                while at < windows:
                    block = (place - at) // strip  # windows that start that many strips before the anchor
                    first = place - block * strip  # where the last window of a whole strip starts
                    last = min(windows, first + 1)
                    owner.append(k)
                    off.append(at)
                    size.append(last - at)
                    core.append(xxhash.xxh3_64_intdigest(content[first : first + length - strip + 1], seed=block) - 2**63)
                    seg.append(xxhash.xxh3_64_intdigest(content[at : last + length - 1]) - 2**63)
                    at = last
            which = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(which) for c in ("id", "doc", "start", "anchor", "unique")),
                 pa.array(off, pa.int32()), pa.array(size, pa.int32()), pa.array(core, pa.int64()), pa.array(seg, pa.int64())],
                ["id", "doc", "start", "anchor", "unique", "off", "n", "core", "seg"])

    return contents.mapInArrow(run, "id long, doc binary, start long, anchor long, unique boolean, off int, n int, core long, seg long")


def _strip_contents(wanted: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """(doc, start, windows, anchor, core, unique, wide, content) of the wanted strips."""
    asked = wanted.groupBy("id", "doc", "start").agg(F.collect_list(F.struct("off", "n", "core", "wide", "single")).alias("parts"))  # of one segment
    met = contents.join(asked, contents.id.eqNullSafe(asked.id) & (contents.doc == asked.doc) & (contents.start == asked.start))
    part = met.select(contents.doc, contents.start, "anchor", F.col("content"), F.explode("parts").alias("p"))
    return part.select(
        "doc", (F.col("start") + F.col("p.off")).alias("start"), F.col("p.n").alias("windows"), "anchor", F.col("p.core").alias("core"), F.col("p.single").alias("unique"),
        F.col("p.wide").alias("wide"), F.substring("content", F.col("p.off") + 1, F.col("p.n") + (length - 1)).alias("content"))


def repeated_windows(contents: list[bytes], windows: np.ndarray, length: int, memory: int | None = None) -> list[np.ndarray]:
    """For each content, which of its first ``windows`` places start a string of ``length`` bytes that starts elsewhere as well."""
    sizes = np.array([len(c) + 1 for c in contents], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    text = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8).astype(np.int16) + 1
    text[first[1:] - 1] = 0
    wanted = np.zeros(len(text), bool)
    for at, n in zip(first, windows, strict=False):
        wanted[at : at + n] = True
    hit = np.zeros(len(text), bool)
    sorter = Sorter(text, 257) if memory is None else Sorter(text, 257, memory)
    for at, common in sorter.sort():
        # A string of `length` bytes holds no mark, so both neighbours are wanted places or neither is.
        near = common >= length
        near[:-1] |= near[1:].copy()
        hit[at[near]] = True
    hit &= wanted
    return [np.flatnonzero(hit[at : at + n]) for at, n in zip(first, windows, strict=False)]


def _spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of [s, s + length) over sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True))


_SPANS = "doc binary, lo long, hi long"


def _sorted_shards(contents: DataFrame, shards: int, length: int) -> DataFrame:
    """Spans of the unique segments' windows that repeat within their shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]  # a shard's: about SHARD bytes
        if not own:
            return
        held = pa.Table.from_batches(own)
        texts = held.column("content").to_pylist()
        found = repeated_windows(texts, held.column("windows").to_numpy(), length)
        out = []
        for doc, start, unique, places in zip(held.column("doc").to_pylist(), held.column("start").to_pylist(), held.column("unique").to_pylist(), found, strict=True):
            if unique:
                out += [(doc, start + i, start + j) for i, j in _spans(places, length)]
        columns = list(zip(*out, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["doc", "lo", "hi"])

    dealt = contents.repartition(shards, "anchor", "core").select("doc", "start", "windows", "unique", "content")
    return dealt.mapInArrow(run, _SPANS)


def _windows(contents: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, doc, at, unique) of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, doc, start, unique, content in zip(*(batch.column(c) for c in ("anchor", "doc", "start", "unique", "content")), strict=True):
                raw, n = content.as_py(), len(content.as_py()) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor.as_py()] * n, pa.int64()), pa.array([xxhash.xxh3_64_intdigest(raw[k : k + length]) - 2**63 for k in range(n)], pa.int64()),
                     pa.array([doc.as_py()] * n, pa.binary()), pa.array(np.arange(n) + start.as_py()), pa.array([unique.as_py()] * n)],
                    ["anchor", "digest", "doc", "at", "unique"])

    return contents.mapInArrow(run, "anchor long, digest long, doc binary, at long, unique boolean")


def repeated_spans(rows: DataFrame, length: int, scratch: Scratch, shard: int = SHARD, wide: int = WIDE) -> DataFrame:
    """(doc, lo, hi): spans to remove from each distinct text of (id, doc, text), which may overlap."""
    own = scratch.save(segments(rows.where(F.octet_length("text") >= length), length), "segments")
    anchors = own.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    whole = own.join(anchors, "anchor").groupBy("anchor", "seg", "windows", "place").agg(F.count("*").alias("n"), F.min(F.struct("id", "doc", "start")).alias("first"))
    whole = scratch.save(whole, "whole")
    again = whole.where("n > 1").select("anchor", "seg", "windows")
    equal = own.join(again, ["anchor", "seg", "windows"]).select("doc", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (length - 1)).alias("hi")).distinct()
    equal = scratch.save(equal, "equal")
    scratch.drop("segments")

    kinds = whole.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("anchor")
    wanted = whole.join(kinds, "anchor").select("first.*", "windows", "place", "anchor", (F.col("n") == 1).alias("unique"))
    contents = scratch.save(_contents(wanted, rows, length), "contents")

    strips = scratch.save(_strips(contents, length, min(STRIP, length // 2)), "strips")
    alike = strips.groupBy("anchor", "core", "seg", "n").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "doc", "start", "off", "unique")).alias("first"), F.max("unique").alias("unique"))
    alike = scratch.save(alike, "alike")
    twice = alike.where("copies > 1 AND unique").select("anchor", "core", "seg", "n")
    lo = F.col("start") + F.col("off")
    equal2 = strips.where("unique").join(twice, ["anchor", "core", "seg", "n"]).select("doc", lo.alias("lo"), (lo + F.col("n") + (length - 1)).alias("hi"))
    equal2 = scratch.save(equal2, "equal-strips")
    cores = alike.groupBy("anchor", "core").agg(F.count("*").alias("kinds"), F.max(F.expr("copies = 1 AND unique")).alias("open")).where("kinds > 1 AND open")
    met = alike.join(cores.select("anchor", "core", (F.col("kinds") > wide).alias("wide")), ["anchor", "core"])
    met = scratch.save(met.select("first.id", "first.doc", "first.start", "first.off", "n", "core", "wide", F.expr("copies = 1 AND first.unique").alias("single")), "met")
    size = met.where("NOT wide").agg(F.sum(F.col("n") + length)).first()[0] or 0
    parts = _strip_contents(met, contents, length)
    narrow = _sorted_shards(parts.where("NOT wide"), max(1, math.ceil(size / shard)), length)

    windows = _windows(parts.where("wide"), length)
    twice = windows.groupBy("anchor", "digest").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    broad = windows.where("unique").join(twice, ["anchor", "digest"]).select("doc", F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))
    return equal.union(equal2).union(scratch.save(narrow, "narrow")).union(scratch.save(broad, "broad"))


def _word_windows(wanted: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """(digest, row, at, single) of each window of the wanted segments of words."""
    parts = F.collect_list(F.struct("start", "windows", "single")).alias("parts")  # at most a segment a word of one text
    asked = wanted.groupBy("row", "id", "doc").agg(parts)
    met = asked.join(rows, asked.id.eqNullSafe(rows.id) & (asked.doc == rows.doc)).select("row", "parts", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for k, (row, cuts) in enumerate(zip(batch.column("row").to_pylist(), batch.column("parts"), strict=True)):
                raw, cuts = word_hashes(data, offsets[k : k + 2])[0].tobytes(), cuts.as_py()
                at = np.concatenate([np.arange(c["start"], c["start"] + c["windows"]) for c in cuts])
                digest = [xxhash.xxh3_64_intdigest(raw[8 * i : 8 * (i + words)]) - 2**63 for i in at.tolist()]
                single = np.repeat([c["single"] for c in cuts], [c["windows"] for c in cuts])
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.int64()), pa.array(np.full(len(at), row)), pa.array(at), pa.array(single)], ["digest", "row", "at", "single"])

    return met.mapInArrow(run, "digest long, row long, at long, single boolean")


def repeated_passages(rows: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """(doc, lo, hi): places of words, which may overlap, of the strings of ``words`` words that stand in two or more rows of (id, doc, text)."""
    numbered = rows.select("id", "doc", F.monotonically_increasing_id().alias("row"), "text")  # tells rows apart, equal ones as well
    own = scratch.save(segments(numbered, words, words=True), "word-segments")
    texts = scratch.save(own.select("row", "id", "doc").distinct(), "word-texts")

    kind, anchor = Window.partitionBy("anchor", "seg", "windows"), Window.partitionBy("anchor")
    met = own.select("row", "start", "windows", "anchor", "seg").repartition("anchor")
    met = met.withColumns({"least": F.min("row").over(kind), "most": F.max("row").over(kind)})
    met = met.withColumns({"low": F.min("least").over(anchor), "high": F.max("most").over(anchor), "open": F.max(F.expr("least = most")).over(anchor)}).where("low < high")
    met = scratch.save(met.select("row", "start", "windows", F.expr("least = most").alias("single"), F.expr("open AND row = least").alias("wanted")), "word-met")
    scratch.drop("word-segments")
    equal = met.where("NOT single").join(texts, "row").select("doc", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (words - 1)).alias("hi"))

    windows = _word_windows(met.where("wanted").join(texts, "row"), rows, words).repartition("digest")
    same = Window.partitionBy("digest")
    windows = windows.withColumns({"met": ~F.min("single").over(same), "apart": F.min("row").over(same) < F.max("row").over(same)}).where("single AND (met OR apart)")
    part = windows.join(texts, "row").select("doc", F.col("at").alias("lo"), (F.col("at") + words).alias("hi"))
    return equal.union(scratch.save(part, "word-part"))


def _doc_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _unions(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(los, his) of each row's spans in order, those that meet as one."""
    ends = np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())))
    lo, hi = (column.flatten().field(k).to_numpy() for k in range(2))
    for a, b in zip(ends, ends[1:], strict=False):
        order = np.argsort(lo[a:b], kind="stable")
        first, reach = lo[a:b][order], np.maximum.accumulate(hi[a:b][order])
        new = np.flatnonzero(first[1:] > reach[:-1]) + 1
        yield (first[np.concatenate(([0], new))], reach[np.append(new, b - a) - 1]) if b > a else (first, reach)


def _cut(docs: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, n_passages, n_passage_words) of (id, text, spans, passages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, text, gone, met in zip(batch.column("id"), batch.column("text"), _unions(batch.column("spans")), _unions(batch.column("passages")), strict=True):
                raw = text.as_py().encode()
                kept = b"".join(raw[lo:hi] for lo, hi in zip([0, *gone[1].tolist()], [*gone[0].tolist(), len(raw)], strict=True))
                out.append((id_.as_py(), len(raw), len(raw) - len(kept), len(gone[0]), kept, len(met[0]), int((met[1] - met[0]).sum())))
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 4 else pa.int64()) for k, c in enumerate(columns)],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept", "n_passages", "n_passage_words"])

    return docs.select("id", "text", "spans", "passages").mapInArrow(
        run, "id long, n_bytes long, n_removed long, n_spans long, kept binary, n_passages long, n_passage_words long")


def without_repeats(documents: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", words: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes that stay of each row's text.

    With ``words`` also (n_passages, n_passage_words): the maximal runs of words, kept or not, that are
    covered by strings of so many words that stand in another row as well, and the words in them.
    """
    scratch = Scratch(documents.sparkSession)
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", _doc_key(F.col("text")).alias("doc"), "text")
    spans = repeated_spans(rows, length, scratch).withColumn("passage", F.lit(False))
    if words:
        spans = spans.union(repeated_passages(rows, words, scratch).withColumn("passage", F.lit(True)))
    span = F.struct("lo", "hi")
    by_doc = spans.groupBy("doc").agg(F.collect_set(F.when(~F.col("passage"), span)).alias("spans"), F.collect_set(F.when(F.col("passage"), span)).alias("passages"))
    cut = _cut(rows.join(scratch.save(by_doc, "by-doc"), "doc", "left")).withColumnRenamed("id", id_col)
    return cut if words else cut.drop("n_passages", "n_passage_words")


def digests(cut: DataFrame) -> DataFrame:
    """``kept`` as its SHA-256, and last as text (a character of which only some bytes stay becomes U+FFFD)."""
    texts = cut.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))
    return texts.withColumn("kept", F.sha2("kept", 256)).withColumnRenamed("kept", "kept_sha256")
