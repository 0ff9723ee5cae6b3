"""Best-fit packing of token pieces into fixed-length sequences, by hierarchical residual packing.

Method.  Items (a key and a length of 1 to ``capacity``) are dealt to tasks, and each task packs its
items by best fit in decreasing length.  Bins that are nearly full are final.  The underfull bins
become items of the next round (a bin is never opened again), dealt to fewer tasks, and so up a tree
of merges, until one task's worth is left or a round no longer merges anything worth its cost.

Scale.  A bin carries its keys as an array, at most ``capacity`` of them as each item has a token;
texts and token ids are never moved.  A task gets about ``task_items`` items in every round, as the
number of tasks follows from the count of what is left; nothing meets in one task that grows with
the input.  Rounds are written to the shared folder.  Items are sorted in the task and dealt by a
hash of their key, so a task that runs again makes the same bins.

Defined cases: an empty table gives no rows; a null or empty text is a document of one end token;
equal keys are allowed (repeated rows): they are packed as separate items; a null length or one out of
1 to ``capacity`` raises; input columns called like one that is made are replaced.
"""

from __future__ import annotations

import functools
import json
import math
import re
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_batches, ship_code, shuffle_partitions, tidy, written

#: The normaliser and splits of the files whose ids this module puts together from pieces of words; any other file
#: gets whole texts.  Fixed values.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Texts of these characters alone are put together from pieces: letters, digits, marks and spaces that are letters,
#: digits, marks and spaces in every version of Unicode, with one lower case, and that no normalisation joins.  The tests
#: hold each of them against the tokenizer.  A text with any other character is encoded as it is.
KNOWN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u0148\u014a-\u017e\u0391-\u03a1\u03a4-\u03a9\u03b1-\u03c9\u0400-\u045f"
                      "\u2010-\u2027\u2030-\u205e\u20ac\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")
KNOWN_LATIN = bytes(b for b in range(256) if KNOWN.fullmatch(chr(b)))
#: Pieces kept with their ids by each worker: some 230 bytes each.  The ids don't depend on it.
CACHE_WORDS = 300_000
#: Whose tasks a worker keeps its tokenizers and words for (``common.kept``).
OWNER = "packing"


def odd(text: str) -> bool:
    """Whether a text has to go to the tokenizer as it is: another character than the known ones, or a special token."""
    if "<|" in text:
        return True
    try:
        return bool(text.encode("latin-1").translate(None, KNOWN_LATIN))
    except UnicodeEncodeError:
        return KNOWN.fullmatch(text) is None


def known_file(path: str) -> bool:
    """Whether a tokenizer file normalises and splits as this module does."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    return (spec.get("normalizer") == NORMALIZER and spec.get("pre_tokenizer") == PRE_TOKENIZER
            and model.get("type", "BPE") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
            and not model.get("ignore_merges") and all(t["content"].startswith("<|") for t in spec.get("added_tokens", [])))


#: Code points that are split into pieces together, up to the next space.
BLOCK = 1 << 19
SPACES = " \t\n\r"  # the white space among the known characters
LETTER, DIGIT, OTHER = 1, 2, 3


@functools.cache
def _kinds() -> np.ndarray:
    """For each code point up to the last known one 4 * the bytes of its UTF-8 + its kind; 0 for white space."""
    kinds = np.zeros(0xD7A4, np.uint8)
    for i in range(len(kinds)):
        c = chr(i)
        if KNOWN.fullmatch(c) and c not in SPACES:
            kinds[i] = 4 * len(c.encode()) + {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], OTHER)
    return kinds


def split_pieces(text: str) -> tuple[np.ndarray, pa.StringArray]:
    """The pieces that SPLIT makes of a text of known characters in lower case, with the position of each."""
    points = np.frombuffer((text + "\n\n").encode("utf-32-le"), np.uint32)
    kinds = _kinds()[points]
    kind = kinds & 3
    start = kind != 0
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # A shortened word ('s, 'll) is a piece where its apostrophe begins one; letters behind it are the next.
    mark = np.flatnonzero((points == ord("'")) & start)
    one, two = points[mark + 1], points[mark + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[mark[short | long] + 1] = False
    end = np.concatenate([mark[short] + 2, mark[long] + 3])
    start[end] |= kind[end] == LETTER
    at = np.flatnonzero(start)
    ends = np.cumsum(kinds >> 2, dtype=np.int32)  # in bytes, white space left out
    offsets = np.append(ends[at] - (kinds[at] >> 2), ends[-1]).astype(np.int32)
    raw = text.encode().translate(None, SPACES.encode())
    return at, pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw))


class WordIds:
    """Token ids of whole texts, each distinct piece of them tokenized once as long as it stays in the cache.

    For files of the known kind (``known_file``): the tokenizer drops white space, splits texts as SPLIT does and marks the end of each piece, so the
    ids of a text are those of its pieces in order.  Unseen pieces are tokenized together, in one call for many.  Other files,
    and texts with other characters than the known ones, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.path = path
        self.known = known_file(path)
        # For pieces that are normalised and split already, with their bytes written as the model has them: the file's
        # model behind a split at spaces.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.plain.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # Byte-level: printable bytes stand for themselves, the others for the characters from U+0100 on.
        shown = np.isin(np.arange(256), [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
        self.shown = np.where(shown, np.arange(256), 255 + np.cumsum(~shown)).astype("<u2")
        self.shown[ord(" ")] = ord(" ")
        self.words: dict[str, bytes] = {}

    @functools.cached_property
    def tokenizer(self):
        """The file's tokenizer as it is; most workers never need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, unseen: list[str]) -> None:
        """Put pieces, new to ``self.words``, into it."""
        for a in range(0, len(unseen), 500):
            new = unseen[a:a + 500]
            line = self.shown[np.frombuffer(" ".join(new).encode(), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(self.plain.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
            if len(cuts) == len(new) + 1:
                raw = ids.tobytes()
                self.words.update(zip(new, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
            else:  # a piece without an end mark: each by itself
                self.words.update((p, self.whole(p)) for p in new)

    def joined(self, text: str, begins: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids of a text of known characters; how many of their bytes stand before each of ``begins`` (sorted), and in all."""
        parts, cuts, done, a = [], [], 0, 0
        while a < len(text):
            b = text.find(" ", a + BLOCK)
            b = len(text) if b < 0 else b
            at, pieces = split_pieces(text[a:b].lower())
            coded = pieces.dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            self.learn([p for p in distinct if p not in self.words])
            size, raw = np.zeros(1, np.int32), b""
            if len(at):
                _, size, raw = pa.array(list(map(self.words.__getitem__, distinct)), pa.binary()).take(coded.indices).buffers()
                size = np.frombuffer(size, np.int32, len(at) + 1)
            parts.append(memoryview(raw)[:size[-1]])
            here = begins[np.searchsorted(begins, a):np.searchsorted(begins, b)]
            cuts.append(done + size[np.searchsorted(at, here - a)].astype(np.int64))
            done += int(size[-1])
            a = b
        return b"".join(parts), np.append(np.concatenate(cuts), done)

    def batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known = [self.known and not odd(t) for t in texts]
        some = [t for t, k in zip(texts, known) if k]
        if not some:
            return [self.whole(t) for t in texts]
        begins = np.cumsum([0, *[len(t) + 1 for t in some[:-1]]])
        raw, cuts = self.joined("\n".join(some) + "\n", begins)
        made = iter([raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())])
        return [next(made) if k else self.whole(t) for t, k in zip(texts, known)]


def word_ids(path: str) -> WordIds:
    """The worker's own instance for a tokenizer file."""
    held = kept(OWNER)
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
             id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """Pieces of whole documents: ``doc_id, piece, start, length`` and ``ids`` (binary, little-endian u32).

    A document's ids are those of its text and ``end_id``; longer ones are cut each ``capacity`` ids.
    """
    def run(cols: dict) -> dict:
        out: dict = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
        made = word_ids(tokenizer_path).batch([t or "" for t in cols["t"]])
        end = end_id.to_bytes(4, "little")
        for key, raw in zip(cols["k"], made):
            raw += end
            for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[at:at + 4 * capacity]
                out["doc_id"].append(key)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids"].append(part)
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    pieces = map_batches(docs.select(docs[id_col].alias("k"), docs[text_col].alias("t")), run,
                         f"doc_id {kind}, piece int, start long, length long, ids binary", OWNER)
    return pieces if ids else pieces.drop("ids")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit in the given order: positions of the items of each bin."""
    bins: list[list[int]] = []
    room: list[int] = []  # distinct free amounts of open bins, sorted
    by_room: dict[int, list[int]] = {}
    for at, n in enumerate(lengths):
        k = bisect_left(room, n)
        if k == len(room):
            b, free = len(bins), capacity
            bins.append([])
        else:
            free = room[k]
            b = by_room[free].pop()
            if not by_room[free]:
                del by_room[free]
                room.pop(k)
        bins[b].append(at)
        free -= n
        if free:
            if free not in by_room:
                by_room[free] = []
                insort(room, free)
            by_room[free].append(b)
    return bins


def pack(items: DataFrame, capacity: int = 2048, nearly_full: float = 0.995, task_items: int = 20_000,
         max_rounds: int = 12) -> DataFrame:
    """Pack ``items`` (``length``, 1 to ``capacity``, and any other columns).

    Returns those columns with ``sequence_id`` (unique, otherwise any number) and ``offset``.
    """
    spark = items.sparkSession
    ship_code(spark)
    names = [c for c in items.columns if c.lower() not in ("length", "sequence_id", "offset")]
    element = f"struct<{', '.join(f'`{c}`:{items.schema[c].dataType.simpleString()}' for c in names)}, `length`:bigint>"
    length = F.when(F.col("length").between(1, capacity), F.col("length").cast("long")).otherwise(
        F.raise_error(F.lit(f"a length is null or not in 1..{capacity}")).cast("long"))
    bins = items.select(*names, length.alias("length")).select(
        F.array(F.struct(*names, "length")).alias("members"), F.col("length").alias("filled"))
    bins = written(bins, "pack-items")
    full = math.floor(nearly_full * capacity)
    schema = f"members array<{element}>, offsets array<bigint>, filled bigint, sequence_id bigint"
    done: list[DataFrame] = []
    left = bins.count()
    for level in range(1, max_rounds + 1):
        tasks = max(1, math.ceil(left / task_items))
        if level == 1:  # the first round is as wide as the cluster; later ones as what is left
            tasks = max(tasks, min(shuffle_partitions(spark), math.ceil(left / 500)))
        task = F.pmod(F.xxhash64("members", F.lit(level)), F.lit(tasks)).cast("int")
        packed = written(bins.select("members", "filled", task.alias("task")).repartition(tasks, "task")
                         .select("members", "filled", F.xxhash64("members").alias("spot"))
                         .mapInArrow(tidy(lambda batches, level=level: _merge(batches, capacity, level), OWNER), schema), f"pack-{level}")
        under = packed.where(F.col("filled") < full).count()
        if tasks == 1 or level == max_rounds or under > 0.98 * left:
            done.append(packed)
            break
        done.append(packed.where(F.col("filled") >= full))
        bins, left = packed.where(F.col("filled") < full), under
    whole = done[0]
    for x in done[1:]:
        whole = whole.unionByName(x)
    placed = whole.select("sequence_id", F.explode(F.arrays_zip("members", "offsets")).alias("x"))
    return placed.select(*[F.col(f"x.members.`{c}`").alias(c) for c in names + ["length"]], "sequence_id",
                         F.col("x.offsets").alias("offset"))


def _merge(batches: Iterator[pa.RecordBatch], capacity: int, level: int) -> Iterator[pa.RecordBatch]:
    """One task of one round: best fit over its bins, largest first."""
    from pyspark import TaskContext

    held = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if held is None or not held.num_rows:
        return
    filled, spot = held["filled"].to_numpy(), held["spot"].to_numpy()
    held = held.take(pa.array(np.lexsort((spot, -filled))))
    members, filled = held["members"].combine_chunks(), held["filled"].to_numpy()
    flat, starts = members.values, members.offsets.to_numpy()
    lengths = flat.field("length").to_numpy()
    first = (level << 56) + (TaskContext.get().partitionId() << 28)
    made = best_fit(filled.tolist(), capacity)
    for a in range(0, len(made), 2000):
        part = made[a:a + 2000]
        picks = [np.arange(starts[at], starts[at + 1]) for b in part for at in b]
        cuts = np.concatenate([[0], np.cumsum([sum(starts[at + 1] - starts[at] for at in b) for b in part])]).astype(np.int32)
        picks = np.concatenate(picks)
        n = lengths[picks]
        before = np.cumsum(n) - n
        offsets = before - np.repeat(before[cuts[:-1]], np.diff(cuts))
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array(cuts), flat.take(pa.array(picks))),
             pa.ListArray.from_arrays(pa.array(cuts), pa.array(offsets, pa.int64())),
             pa.array([int(filled[b].sum()) for b in part], pa.int64()),
             pa.array(range(first + a, first + a + len(part)), pa.int64())],
            names=["members", "offsets", "filled", "sequence_id"])
