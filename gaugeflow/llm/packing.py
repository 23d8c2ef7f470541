"""Hierarchical packing of tokenised documents into windows of several context sizes."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.tables import whole_text

#: Context sizes, powers of two; the first is the largest window.
TIERS = (2048, 1024, 512, 256)
#: Tokens that are packed together; a longer document is a group of its own.
GROUP_TOKENS = 1 << 22
#: Tokens of a training step.
STEP_TOKENS = 1 << 17
#: Chunks between blanks, and pieces of them, that a Python worker remembers with their ids; longer ones are not kept.
REMEMBERED, LONGEST = 1 << 19, 64
#: How a tokenizer file has to cut texts so that chunks between blanks can be encoded by themselves.
CUT_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}
#: Chunks of these characters alone are cut here, by the same rules; any other chunk goes to the tokenizer as it is.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Most chunks: one word and what follows it.
USUAL = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|)]*)")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Encoder:
    """Ids of whole texts, as the tokenizer gives them.

    With the rules above no piece crosses a blank, so chunks between blanks are encoded once each and remembered, and so
    are their pieces. With any other rules each text goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.by_chunk = all(rules.get(name) == rule for name, rule in CUT_RULES.items())
        self.special = re.compile("|".join(re.escape(t["content"]) for t in rules.get("added_tokens", [])) or r"(?!)")
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: bytewise.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.piece_ids: dict[str, list[int]] = {}
        self.ids, self.first = array("I"), array("q", [0])

    def _of_piece(self, piece: str) -> list[int]:
        shown = piece if piece.isascii() else piece.translate(self.shown)
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        if len(piece) <= LONGEST:
            self.piece_ids[piece] = ids
        return ids

    def _of_chunk(self, chunk: str) -> list[int]:
        known, usual = self.piece_ids, USUAL.fullmatch(chunk)
        if usual:
            word, tail = usual[1].lower(), usual[2]
            ids = known.get(word) or self._of_piece(word)
            return ids + (known.get(tail) or self._of_piece(tail)) if tail else ids
        if not PLAIN.fullmatch(chunk) or self.special.search(chunk):
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        found = PIECE.findall(chunk.lower())
        return [i for p in found for i in (known.get(p) or self._of_piece(p))]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        if not self.by_chunk:
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self.place) > REMEMBERED or len(self.piece_ids) > REMEMBERED:
            self.forget()
        place, long, numbers = self.place, False, []
        for text in texts:
            chunks = text.replace("\n", " ").split(" ")
            at = list(map(place.get, chunks))
            if None in at:
                for i, chunk in enumerate(chunks):
                    if at[i] is None:
                        if chunk not in place:
                            self.ids.extend(self._of_chunk(chunk))
                            place[chunk] = len(self.first) - 1
                            self.first.append(len(self.ids))
                            long |= len(chunk) > LONGEST
                        at[i] = place[chunk]
            numbers.append(np.array(at, np.int64))
        first, ids = np.array(self.first), np.array(self.ids)
        found = []
        for at in numbers:
            begin, count = first[at], first[at + 1] - first[at]
            ends = np.cumsum(count)
            found.append(ids[np.repeat(begin - ends + count, count) + np.arange(ends[-1])])
        if long:
            self.forget()
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder per Python worker; what it remembers serves all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack_group(lengths: np.ndarray, tiers: Sequence[int] = TIERS) -> tuple[np.ndarray, np.ndarray]:
    """Windows for documents of the given lengths: pieces ``doc, start, length, window, offset``, and window sizes.

    1. Each document is cut into windows of the largest size; what is left goes to the smallest tier that holds it.
    2. From the largest tier down, each rest opens a window of its tier. The gap takes the longest rests that fit, and
       when none does, the head of one from the shortest tier that has any.
    3. Once a gap finds nothing any more, the rests still unplaced follow each other through windows of the largest size.
       The last of these is cut into the largest powers of two, so no window is padded at all.
    """
    top = tiers[0]
    lengths = np.asarray(lengths, np.int64)
    full, left = lengths // top, lengths % top
    doc = np.repeat(np.arange(len(lengths)), full)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)) * top
    pieces = [np.stack([doc, start, np.full(len(doc), top), np.arange(len(doc)), np.zeros(len(doc), np.int64)], 1)]
    sizes = [top] * len(doc)
    stock: list[list[tuple[int, int]]] = [[] for _ in range(top)]  # (document, start) of the rests by length
    for d in np.flatnonzero(left).tolist():
        stock[int(left[d])].append((d, int(full[d]) * top))
    filled = sum(1 << n for n, rests in enumerate(stock) if rests)  # one bit for each length in stock

    def at_most(n: int) -> int:
        return max((filled & ((2 << n) - 1)).bit_length() - 1, 0)

    def take(length: int) -> tuple[int, int]:
        nonlocal filled
        rest = stock[length].pop()
        if not stock[length]:
            filled ^= 1 << length
        return rest

    def put(d: int, begin: int, length: int) -> None:
        nonlocal filled
        stock[length].append((d, begin))
        filled |= 1 << length

    found: list[tuple[int, int, int, int, int]] = []
    unplaced: list[tuple[int, int, int]] = []
    for k, size in enumerate(tiers):
        floor = tiers[k + 1] if k + 1 < len(tiers) else 0
        while True:
            length = at_most(min(size, top - 1))
            if length <= floor:
                break
            window = [(*take(length), length)]
            gap = size - length
            while gap:
                length = at_most(gap)
                if length:
                    window.append((*take(length), length))
                    gap -= length
                    continue
                length = next((n for t in reversed(tiers[k + 1:]) if (n := at_most(min(t, top - 1))) > gap), 0)
                if not length:
                    break
                d, begin = take(length)
                window.append((d, begin, gap))
                put(d, begin + gap, length - gap)
                gap = 0
            if gap:
                unplaced += window
                continue
            at = 0
            for d, begin, length in window:
                found.append((d, begin, length, len(sizes), at))
                at += length
            sizes.append(size)
    total = sum(n for _, _, n in unplaced)
    ends = [top] * (total // top) + [1 << b for b in range(top.bit_length() - 1, -1, -1) if total % top >> b & 1]
    at, room = 0, ends[0] if ends else 0
    number = 0
    for d, begin, length in unplaced:
        while length:
            part = min(length, room - at)
            found.append((d, begin, part, len(sizes) + number, at))
            begin, length, at = begin + part, length - part, at + part
            if at == room and number + 1 < len(ends):
                number, at, room = number + 1, 0, ends[number + 1]
            elif at == room:
                at = 0
    sizes += ends
    pieces.append(np.array(found, np.int64).reshape(-1, 5))
    return np.concatenate(pieces), np.array(sizes, np.int64)


def step_groups(sizes: np.ndarray, step_tokens: int) -> np.ndarray:
    """A step for each window, so that steps hold about as many tokens: largest windows first, each to the emptiest step."""
    steps = max(1, round(int(sizes.sum()) / step_tokens))
    order = np.argsort(-sizes, kind="stable")
    step = np.zeros(len(sizes), np.int64)
    load, at = np.zeros(steps, np.int64), 0
    while at < len(order):  # a whole round of equal windows at a time
        size = sizes[order[at]]
        emptiest = np.argsort(load, kind="stable")
        lowest = emptiest[load[emptiest] + size <= load[emptiest[0]] + 2 * size - 1]
        batch = order[at:at + len(lowest)]
        batch = batch[sizes[batch] == size]
        step[batch] = lowest[:len(batch)]
        load[lowest[:len(batch)]] += size
        at += len(batch)
    return step


def _packed(tokenizer: str, end_id: int, tiers: Sequence[int], group_tokens: int, step_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(tokenizer).encode
        window_base = step_base = TaskContext.get().partitionId() << 40
        rows, ids, tokens = [], [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            nonlocal window_base, step_base, rows, ids, tokens
            lengths = np.array([len(x) for x in ids], np.int64)
            pieces, sizes = pack_group(lengths, tiers)
            steps = step_groups(sizes, step_tokens)
            doc, start, length, window, offset = pieces.T
            keys = pa.concat_arrays(rows)
            for a in range(0, len(doc), 4096):
                b = slice(a, a + 4096)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(doc[b])), pa.array(start[b]), pa.array(length[b]), pa.array(lengths[doc[b]]),
                     pa.array(window[b] + window_base), pa.array(offset[b]), pa.array(sizes[window[b]]),
                     pa.array(steps[window[b]] + step_base),
                     pa.array([ids[d][s:s + n].astype("<u4").tobytes() for d, s, n in
                               zip(doc[b].tolist(), start[b].tolist(), length[b].tolist())], pa.binary())],
                    ["row", "start", "length", "doc_tokens", "sequence_id", "offset", "context", "step", "ids"],
                )
            window_base += len(sizes)
            step_base += int(steps.max(initial=-1)) + 1
            rows, ids, tokens = [], [], 0

        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= 1 << 20):
                    size += len(texts[upto])
                    upto += 1
                found = encode(texts[at:upto])
                ids += [np.append(x, np.uint32(end_id)) for x in found]
                rows.append(batch.column(0).slice(at, upto - at))
                tokens += sum(map(len, ids[len(ids) - len(found):]))
                at = upto
                if tokens >= group_tokens:
                    yield from sent()
        if ids:
            yield from sent()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    tiers: Sequence[int] = TIERS,
    group_tokens: int = GROUP_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, context, step, ids``.

    A document is the ids of its whole text by the ``tokenizer`` file, then ``end_id``; null and empty texts are that id
    alone. It is cut into pieces, each id in exactly one; pieces with one ``sequence_id`` follow each other by ``offset``
    and fill a window of ``context`` ids completely: the tiers, and at the end of a group any power of two. ``step``
    numbers groups of windows with about ``step_tokens`` ids. ``ids`` are little-endian 32-bit integers. Repeated rows
    are packed each by itself; an empty table gives no rows; extra columns are not read.

    A map task packs groups of about ``group_tokens`` ids one after the other and holds no more than one group, so
    nothing is shuffled and the work is linear. Sequences never leave a task, so a task that is run again replaces its
    own alone. There is no padding at the end of groups, so small input files cost short windows, not padding.
    """
    rows = docs.select(F.col(doc_id).alias("row"), whole_text(text).alias("text"))
    long = T.LongType()
    packed = rows.mapInArrow(
        _packed(tokenizer, end_id, tuple(tiers), group_tokens, step_tokens),
        T.StructType([T.StructField("row", rows.schema["row"].dataType)] + [
            T.StructField(c, long) for c in
            ("start", "length", "doc_tokens", "sequence_id", "offset", "context", "step")
        ] + [T.StructField("ids", T.BinaryType())]),
    )
    return packed.withColumnRenamed("row", doc_id)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, step, context, ids``: whole windows, the ids of their pieces joined by offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id", "step", "context").agg(parts.alias("parts")).select(
        "sequence_id", "step", "context",
        F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"])).alias("ids"),
    )
