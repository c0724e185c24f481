"""Best-fit packing of token sequences by bin completion.

Documents become token ids and pieces of at most ``capacity``. Pieces of one
length are alike, so the search runs on the histogram of lengths, which has at
most ``capacity`` entries however many pieces there are. It fills one bin at a
time around the longest piece left: of the undominated fillings it tries those
that waste least, applies one as often as the counts allow, and drops branches
whose waste cannot lead to fewer bins than the incumbent, at first best-fit
decreasing. Each piece then finds its place by its rank among the pieces of its
length; ranks are counted by length and bucket, so no length is one task's work.
"""

from __future__ import annotations

import bisect
import json
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import small_batches, steps

CAPACITY = 2048
END_ID = 0
#: Fillings tried for one longest piece, and steps of the whole search.
WIDTH, NODES = 6, 3000
#: Lengths of a filling up to which it is tried whether one piece can stand for two.
PAIRED = 8
#: Words that a worker process remembers for sure; it holds up to twice as many and those of one encoding, at about 160 bytes each.
REMEMBERED = 400_000
#: Bytes of text, and for each row of output, from which batches are encoded together: the more, the fewer lookups a word.
GATHERED, ROW = 1 << 20, 64
#: Buckets in which the ranks of one length are counted.
BUCKETS = 64

Plan = list[tuple[int, tuple[int, ...]]]  # how many bins, the lengths in each


# --- search over the histogram ----------------------------------------------


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Longest first, each piece into the fullest bin that holds it, alike bins and pieces together."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}  # by room left
    rooms: list[int] = []
    done: Plan = []

    def put(room: int, filling: tuple[int, ...], n: int) -> None:
        if room == 0:
            done.append((n, filling))
            return
        if room not in open_bins:
            open_bins[room] = {}
            bisect.insort(rooms, room)
        open_bins[room][filling] = open_bins[room].get(filling, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect.bisect_left(rooms, length)
            if k == len(rooms):
                # New bins, each filled with as many of these pieces as go in: the fullest bin takes the next one.
                each = min(capacity // length, left)
                n = left // each
                put(capacity - each * length, (length,) * each, n)
                left -= n * each
                continue
            room = rooms[k]
            filling, n = next(iter(open_bins[room].items()))
            each = min(room // length, left)
            n = min(n, left // each)
            open_bins[room][filling] -= n
            if not open_bins[room][filling]:
                del open_bins[room][filling]
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(k)
            put(room - each * length, (*filling, *(length,) * each), n)
            left -= n * each
    return done + [(n, f) for by in open_bins.values() for f, n in by.items()]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by volume, and by the pieces too long to share with pieces of ``k`` or more."""
    total = sum(length * n for length, n in counts.items())
    best = -(-total // capacity)
    for k in {length for length in counts if 2 * length <= capacity} | {0}:
        alone = sum(n for length, n in counts.items() if length > capacity - k)
        half = [(length, n) for length, n in counts.items() if capacity - k >= length > capacity / 2]
        rest = sum(length * n for length, n in counts.items() if k <= length <= capacity / 2)
        pairs = sum(n for _, n in half)
        room = pairs * capacity - sum(length * n for length, n in half)
        best = max(best, alone + pairs + max(0, -(-(rest - room) // capacity)))
    return best


@dataclass
class _Search:
    capacity: int
    total: int
    bound: int
    plan: Plan
    bins: int
    nodes: int = 0

    def fillings(self, counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, tuple[int, ...]]]:
        """Undominated fillings of ``room`` as (waste, lengths), least waste and fewest pieces first.

        A filling is dominated if a piece that is left fits beside it, if a
        longer piece can stand for one of its own within the waste, or if one
        piece can stand for two of them.
        """
        found: list[tuple[int, tuple[int, ...]]] = []
        budget = [20 * WIDTH]

        def fits(length: int, chosen: tuple[int, ...]) -> bool:
            return counts.get(length, 0) > chosen.count(length)

        def dominated(chosen: tuple[int, ...], waste: int) -> bool:
            # Fillings of many lengths are looked at one piece at a time only.
            kinds = sorted(set(chosen), reverse=True)
            for a in range(len(kinds)):
                again = [2 * kinds[a]] if chosen.count(kinds[a]) > 1 else []
                lows = [kinds[a]] + (again + [kinds[a] + c for c in kinds[a + 1 :]] if len(kinds) <= PAIRED else [])
                for k, low in enumerate(lows):
                    at = bisect.bisect_right(lengths, low + waste) - 1
                    if at >= 0 and (lengths[at] > low if k == 0 else lengths[at] >= low) and fits(lengths[at], chosen):
                        return True
            return False

        def extend(chosen: tuple[int, ...], room: int, top: int) -> None:
            if budget[0] <= 0 or len(found) >= 4 * WIDTH:
                return
            budget[0] -= 1
            at = bisect.bisect_right(lengths, min(room, top)) - 1
            grown = False
            tried = 0
            while at >= 0 and tried < WIDTH:
                length = lengths[at]
                if fits(length, chosen):
                    grown = True
                    tried += 1
                    extend((*chosen, length), room - length, length)
                    if found and found[-1][0] == 0 and len(found) >= WIDTH:
                        return
                at -= 1
            if not grown and not dominated(chosen, room):
                found.append((room, chosen))

        extend((), room, room)
        found.sort(key=lambda f: (f[0], len(f[1])))
        return found[:WIDTH]

    def run(self, counts: dict[int, int]) -> None:
        """Branch on the bin of the longest piece left, depth first.

        One histogram is changed and changed back along the path, so memory
        does not grow with the number of branches.
        """
        lengths = sorted(counts)  # those with pieces left
        frames: list[list] = []  # branches to try, place of the next one
        path: list[tuple[int, tuple[int, ...], int]] = []  # bins, filling, waste
        used = waste = 0

        def move(n: int, filling: tuple[int, ...], sign: int) -> None:
            for length in set(filling):
                before = counts[length]
                counts[length] -= sign * n * filling.count(length)
                if counts[length] == 0:
                    lengths.pop(bisect.bisect_left(lengths, length))
                elif before == 0:
                    bisect.insort(lengths, length)

        while True:
            # Bins so far and the least that the rest can need, its volume given what is wasted.
            open_ = max(used, -(-(self.total + waste) // self.capacity)) < self.bins
            if open_ and not lengths:
                self.plan, self.bins = [(n, filling) for n, filling, _ in path], used
                open_ = False
            if self.nodes >= NODES or self.bins <= self.bound:
                return
            if open_:
                self.nodes += 1
                longest = lengths[-1]
                counts[longest] -= 1
                frames.append([[(lost, (longest, *chosen)) for lost, chosen in self.fillings(counts, lengths, self.capacity - longest)], 0])
                counts[longest] += 1
            elif path:
                n, filling, lost = path.pop()
                move(n, filling, -1)
                used, waste = used - n, waste - n * lost
            while frames and frames[-1][1] == len(frames[-1][0]):
                frames.pop()
                if not frames:
                    return
                n, filling, lost = path.pop()
                move(n, filling, -1)
                used, waste = used - n, waste - n * lost
            if not frames:
                return
            lost, filling = frames[-1][0][frames[-1][1]]
            frames[-1][1] += 1
            n = min(counts[length] // filling.count(length) for length in set(filling))
            move(n, filling, 1)
            used, waste = used + n, waste + n * lost
            path.append((n, filling, lost))


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Bins for a histogram of lengths up to ``capacity``, as few as the search finds."""
    counts = {length: n for length, n in counts.items() if n > 0 and length > 0}
    full = counts.pop(capacity, 0)
    plan = best_fit_decreasing(counts, capacity)
    if counts:
        total = sum(length * n for length, n in counts.items())
        search = _Search(capacity, total, lower_bound(counts, capacity), plan, sum(n for n, _ in plan))
        search.run(counts)
        plan = search.plan
    return ([(full, (capacity,))] if full else []) + plan


# --- tokens and pieces ------------------------------------------------------


def tokenizer_json(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


class Encoder:
    """Token ids of texts, word by word.

    The tokenizer drops white space, lowers letters and parts letters from
    signs, and looks at nothing beyond them. So a text's ids are those of its
    words, and a word's are those of its letters and of the ASCII signs that
    follow them. Each is encoded once and remembered.
    """

    #: ASCII signs but the apostrophe, which may belong to the letters beside it.
    SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
    #: Turns small letters into a, such signs into !.
    KINDS = bytes.maketrans(bytes(range(97, 123)) + SIGNS, b"a" * 26 + b"!" * len(SIGNS))
    #: A special token that parts words in one call.
    PART = "<|endoftext|>"

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.part = self.tokenizer.token_to_id(self.PART)
        suffix = json.loads(spec)["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        #: Ids that end a run of letters.
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, number in vocabulary.items() if suffix else ():
            self.ends[number] = token.endswith(suffix)

    def _ids(self, text: bytes) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Words' ids into ``known``. Those of letters alone are one run each, so the ids that end a run part them;
        others are parted by a special token, or encoded one by one."""
        letters = [word for word in words if word.isalpha()]  # of ASCII, by far the most
        plain, odd = [], []
        for word in words if len(letters) < len(words) else ():
            if word.isalpha():
                continue
            if unicodedata.normalize("NFC", word.decode("utf-8", "replace")).lower().isalpha():
                letters.append(word)
            elif self.part is not None and b"<|" not in word:
                plain.append(word)
            else:
                odd.append(word)
        for k in range(0, len(letters), 256):
            some = letters[k : k + 256]
            ids = self._ids(b" ".join(some))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                odd += some
                continue
            self._part(some, ids, [0, *cuts[:-1].tolist()], cuts.tolist())
        for k in range(0, len(plain), 128):
            some = plain[k : k + 128]
            ids = self._ids(self.PART.encode().join(some))
            cuts = np.flatnonzero(ids == self.part)
            self._part(some, ids, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])
        for word in odd:
            self.known[word] = self._ids(word).tobytes()

    def _part(self, words: list[bytes], ids: np.ndarray, starts: list[int], stops: list[int]) -> None:
        data = ids.tobytes()
        self.known.update(zip(words, [data[4 * a : 4 * b] for a, b in zip(starts, stops, strict=True)], strict=True))

    def _spaced(self, texts: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The texts lowered, ASCII signs after a letter apart. Texts that may hold special tokens stay as they are."""
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2].slice(starts[0], starts[-1] - starts[0]).to_pybytes() if starts[-1] > starts[0] else b""
        starts = starts - starts[0]
        lowered = np.frombuffer(bytearray(data.lower()), np.uint8)
        kinds = np.frombuffer(bytearray(lowered.tobytes().translate(self.KINDS)), np.uint8)
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if special.any():
            same = np.repeat(special, np.diff(starts))
            lowered[same], kinds[same] = np.frombuffer(data, np.uint8)[same], 0
        edges = np.zeros(len(data) + 1, bool)
        edges[1:-1] = (kinds[1:] == ord("!")) & (kinds[:-1] == ord("a"))
        edges[starts] = False  # the letter belongs to the text before
        at = np.flatnonzero(edges)
        apart, starts = np.insert(lowered, at, 32), starts + np.searchsorted(at, starts)
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(starts), pa.py_buffer(apart)])

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        Arrow parts the words, numbers the different ones and puts their ids in
        place, so a word is looked up once for all texts that are given.
        """
        if isinstance(texts, list):
            texts = pa.array([(t or "").encode("utf-8", "surrogatepass") for t in texts], pa.large_binary())
        if not len(texts):
            return []
        spaced = self._spaced(pc.fill_null(texts.cast(pa.large_binary()), b""))
        split = pc.ascii_split_whitespace(spaced.view(pa.large_string()))
        numbered = split.flatten().view(pa.large_binary()).dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = [known.get(w) for w in words]
        gaps = [k for k, code in enumerate(found) if code is None]
        missing = [words[k] for k in gaps]
        again = [older.get(w) for w in missing]
        known.update((w, code) for w, code in zip(missing, again, strict=True) if code is not None)
        self._learn([w for w, code in zip(missing, again, strict=True) if code is None])
        for k, w in zip(gaps, missing, strict=True):
            found[k] = known[w]
        ids = pa.array(found, pa.large_binary()).take(numbered.indices)
        return pc.binary_join(pa.ListArray.from_arrays(split.offsets, ids), pa.scalar(b"", pa.large_binary())).to_pylist()


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One encoder for each worker process, so that words stay known from task to task."""
    key = zlib.crc32(spec.encode()), len(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The two columns of the batches, those of ``GATHERED`` bytes of text together, the second as binary."""
    ids, texts, size = [], [], 0
    for batch in batches:
        ids.append(batch.column(0))
        texts.append(batch.column(1).cast(pa.large_binary()))
        size += texts[-1].nbytes + ROW * len(batch)
        if size >= GATHERED:
            yield pa.concat_arrays(ids), pa.concat_arrays(texts)
            ids, texts, size = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), pa.concat_arrays(texts)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of each piece of ``docs(doc_id, text)``.

    A document is its ids and then ``END_ID``; a null text has only that.
    """
    spec = tokenizer_json(tokenizer)
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec)
        end = np.asarray([END_ID], "<u4").tobytes()
        for ids, texts in _gathered(batches):
            out: list[list] = [[], [], [], [], []]
            for doc_id, code in zip(ids.to_pylist(), encoder.encode(texts), strict=True):
                code += end
                for piece, start in enumerate(range(0, len(code) // 4, capacity)):
                    part = code[4 * start : 4 * (start + capacity)]
                    for column, value in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (ids.type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# --- places -----------------------------------------------------------------


def _slots(plan: Plan) -> dict[int, np.ndarray]:
    """For each length the runs of its pieces: first rank, first bin, pieces a bin, place of the first, by rank."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for n, filling in plan:
        place = 0
        for length in sorted(set(filling), reverse=True):
            each = filling.count(length)
            rank = ranks.get(length, 0)
            runs.setdefault(length, []).append((rank, first, each, place))
            ranks[length] = rank + n * each
            place += each * length
        first += n
    return {length: np.asarray(r, np.int64) for length, r in runs.items()}


def place(cut: DataFrame, capacity: int = CAPACITY, label: str = "pack") -> DataFrame:
    """``cut`` (a written table of pieces) with ``sequence_id`` and ``offset``.

    The driver sees the histogram of lengths, ``capacity`` rows at most. The
    search is the same for the same histogram, so a retried task agrees.
    """
    store = steps(cut.sparkSession, label)
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = {length: runs.tolist() for length, runs in _slots(solve(counts, capacity)).items()}
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int")
    keyed = cut.withColumn("bucket", bucket)
    sums = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("length").orderBy("bucket")) - F.col("n")
    # At most capacity * BUCKETS rows of three numbers.
    sums = F.broadcast(store.save(sums.select("length", "bucket", upto.alias("before")), "buckets"))
    order = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("rank", F.row_number().over(order) - 1).join(sums, ["length", "bucket"])
    ranked = ranked.select(*cut.columns, (F.col("rank") + F.col("before")).alias("rank"))
    text = json.dumps(slots)
    at, names = ranked.columns.index("rank"), [*cut.columns, "sequence_id", "offset"]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = {int(length): np.asarray(r, np.int64) for length, r in json.loads(text).items()}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                here = length == one
                table = runs[int(one)]
                run = table[np.searchsorted(table[:, 0], rank[here], "right") - 1]
                step = rank[here] - run[:, 0]
                sequence[here] = run[:, 1] + step // run[:, 2]
                offset[here] = run[:, 3] + step % run[:, 2] * one
            kept = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(seat, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, label: str = "pack") -> DataFrame:
    """One row for each piece of ``docs(doc_id, text)``: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    Pieces of equal length may change places without changing the packing;
    rows with equal ids and texts are packed as often as they come. Other
    columns are ignored; an empty table gives no rows.
    """
    cut = steps(docs.sparkSession, label).save(pieces(docs, capacity, tokenizer), "pieces")
    return place(cut, capacity, label)


def query(spark, sf: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf}/documents.parquet"))
