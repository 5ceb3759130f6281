"""Best-fit packing of tokenised documents into sequences, hierarchically.

1. Texts -> token ids -> pieces of at most ``seq_len`` tokens (only documents
   longer than that are cut); the ids themselves are only hashed, not moved.
2. Pieces are dealt over partitions of about ``GROUP`` pieces by a hash (a key
   of many rows cannot pile up) and packed best-fit decreasing in each. Nearly
   full sequences are final and leave.
3. Underfull sequences become items of (id, fill) and are packed again, those of
   many groups in one task, round after round until one group is left. Two
   sequences join only if one is at most half full, and best fit leaves no more
   than one such in a group; so of the fuller ones only as many go on, the
   emptiest, as there are such partners, and the rest is final. A round thus has
   at most about two items for each group of the round before it, however many
   underfull sequences there are, and no task gets more than about ``GROUP``.
4. Pieces take the place that their sequence was given, by a join on its id.

Defined results: null text is the empty text (one piece holding just the end
id). Rows are packed as they are: repeated rows and null doc_ids each get their
own place. Extra columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm.common import Scratch, arrow_map, at_work

SEQ_LEN = 4096
END_ID = 1
GROUP = 50_000          # pieces packed together in a task of the first round
NEARLY_FULL = 0.97      # a sequence this full is final at once
CACHE_BYTES = 80 << 20  # words and runs remembered in a Python worker, with what a dictionary needs for each
ENTRY_BYTES = 160       # of a dictionary, beside the characters
LONG_RUN = 256          # longer ones are not remembered

# A text of these characters only is cut into words here, by the tokenizer's own
# published pattern (its \p{L} and \p{N} are the classes below for them); any
# other text goes to the library in its space-separated runs.
_PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The tokenizer never joins characters across white space or across the words
    of its pattern, so a text's ids are those of its words in order, and a word
    is encoded by the library once and remembered. New words are encoded many
    at a time; their ids are cut apart after the ids that end a word, and where
    the number of cuts is not the number of words, each is encoded alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for piece, i in vocab.items():
            self.ends[i] = piece.endswith("</w>")
        special = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)")
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.held = 0

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        for lo in range(0, len(words), 256):
            part = words[lo:lo + 256]
            ids = self._library([" ".join(part)])[0]
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                self.words.update((w, one.tobytes()) for w, one in zip(part, self._library(part)))
                continue
            raw, at = ids.tobytes(), 0
            for w, stop in zip(part, (4 * stops).tolist()):
                self.words[w] = raw[at:stop]
                at = stop

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut, by_word = [], []
        for t in texts:
            plain = not t or bool(_PLAIN.fullmatch(t) and not self.special.search(t))
            by_word.append(plain)
            cut.append(_WORDS.findall(t.lower()) if plain and t else (t or "").replace("\n", " ").split(" "))
        if self.held > CACHE_BYTES:
            self.words.clear()
            self.runs.clear()
            self.held = 0
        long = []
        for known, learn, want in ((self.words, self._learn_words, True), (self.runs, self._learn_runs, False)):
            new = set().union(*[ws for ws, plain in zip(cut, by_word) if plain == want]).difference(known)
            if new:
                learn(list(new))
                long += [(known, w) for w in new if len(w) > LONG_RUN]
                self.held += sum(map(len, new)) + ENTRY_BYTES * len(new)
        out = [b"".join(map((self.words if plain else self.runs).__getitem__, ws))
               for ws, plain in zip(cut, by_word)]
        for known, w in long:
            del known[w]
            self.held -= len(w) + ENTRY_BYTES
        return out

    def _learn_runs(self, runs: list[str]) -> None:
        self.runs.update((r, one.tobytes()) for r, one in zip(runs, self._library(runs)))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _pieces_fn(path: str | None, seq_len: int, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def fn(cols):
        at_work("packing", encoder.cache_clear)
        out = {f.name: [] for f in schema}
        for lo in range(0, len(cols["text"]), 64):
            raw_ids = encoder(path or default_tokenizer()).encode(cols["text"][lo:lo + 64])
            for doc, raw in zip(cols["doc_id"][lo:lo + 64], raw_ids):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * seq_len)):
                    part = raw[at:at + 4 * seq_len]
                    for name, v in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[name].append(v)
        return out

    return arrow_map(fn, schema)


def best_fit(sizes: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: for each item its bin and offset there; the fill of
    each bin. Open bins are found by a bit set over residual capacities."""
    bins, offs = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(seq_len + 1)]
    rooms = 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = seq_len, len(fill)
            fill.append(0)
        bins[k], offs[k] = b, fill[b]
        fill[b] += size
        if left := room - size:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offs, np.asarray(fill, np.int64)


_PACKED = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "grp long, seq long, offset long, fill long")


def _pack_fn(seq_len: int):
    """Pieces of a group -> their sequence, offset there and its fill."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offs, fill = best_fit(pdf["length"].to_numpy(), seq_len)
        return pdf.assign(seq=(pdf["grp"].to_numpy() << 24) + bins, offset=offs, fill=fill[bins])

    return run


def _merge_fn(seq_len: int):
    """Underfull sequences of a group -> the sequence that takes each (the one
    at its start keeps its id), how far its pieces shift, and the new fill."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", ignore_index=True)
        bins, offs, fill = best_fit(pdf["fill"].to_numpy(), seq_len)
        seq = pdf["seq"].to_numpy()
        first = np.empty(len(fill), np.int64)
        first[bins[offs == 0]] = seq[offs == 0]
        return pd.DataFrame({"seq": seq, "now": first[bins], "shift": offs, "fill": fill[bins]})

    return run


def joinable(seqs: DataFrame, seq_len: int, full: int) -> DataFrame:
    """The underfull ``seqs(seq, fill)`` worth another round: all that are at
    most half full and about as many of the others, emptiest first."""
    seqs = seqs.where(F.col("fill") < full)
    # one row for each fill, at most seq_len of them
    counts = sorted(map(tuple, seqs.groupBy("fill").count().collect()))
    want = sum(n for f, n in counts if 2 * f <= seq_len)
    take = 2 * F.col("fill") <= seq_len
    for f, n in counts:
        if 2 * f > seq_len and want > 0:
            # of equal ones, as many as wanted by a hash
            some = (F.col("fill") == f) & (F.pmod(F.xxhash64("seq"), F.lit(n)) < want)
            take, want = take | some, want - n
    return seqs.where(take)


def pieces_of(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, seq_len: int = SEQ_LEN,
              end_id: int = END_ID) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_pieces_fn(tokenizer, seq_len, end_id),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, seq_len: int = SEQ_LEN,
                   end_id: int = END_ID, group: int = GROUP, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(pieces_of(spark, docs, tokenizer, seq_len, end_id), "pieces")
    groups = max(1, -(-pieces.count() // group))
    final_cols = ["doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset"]
    # Full pieces are sequences already; no group has to look at them.
    whole = pieces.where(F.col("length") == seq_len).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.lit(-1).cast("long") - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    deal = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length", F.monotonically_increasing_id()),
                  F.lit(groups).cast("long"))
    items = (pieces.where(F.col("length") < seq_len)
             .withColumn("grp", deal).withColumn("seq", F.lit(0).cast("long"))
             .withColumn("offset", F.lit(0).cast("long")).withColumn("fill", F.col("length")))
    packed = scratch.write(items.groupBy("grp").applyInPandas(_pack_fn(seq_len), _PACKED), "packed")
    full = int(nearly_full * seq_len)
    # each sequence has one piece at its start
    seqs, moves, round_no = packed.where("offset = 0").select("seq", "fill"), None, 0
    while groups > 1:
        round_no += 1
        live = scratch.write(joinable(seqs, seq_len, full), f"live{round_no}")
        left = live.count()
        if left < 2:
            break
        groups = min(groups - 1, -(-left // group))
        merged = scratch.write(
            live.withColumn("grp", F.pmod(F.xxhash64("seq"), F.lit(groups).cast("long")))
            .groupBy("grp").applyInPandas(_merge_fn(seq_len), "seq long, now long, shift long, fill long"),
            f"merged{round_no}")
        step = merged.where("shift > 0").select(F.col("seq").alias("was"), F.col("now").alias("then"),
                                                F.col("shift").alias("more"))
        fresh = step.toDF("seq", "now", "shift")
        if moves is not None:
            # what moved before moves on with the sequence that took it
            fresh = fresh.unionByName(moves.join(step, F.col("now") == F.col("was"), "left").select(
                "seq", F.coalesce("then", "now").alias("now"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")))
        moves = scratch.write(fresh, f"moves{round_no}")
        seqs = merged.where("shift = 0").select("seq", "fill")
    if moves is not None:
        packed = (packed.join(moves, "seq", "left").withColumn("seq", F.coalesce("now", "seq"))
                  .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0))))
    return whole.unionByName(packed.select(*final_cols))
