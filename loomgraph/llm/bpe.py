"""Byte-level BPE over whole partitions with a pair occurrence index."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Distinct words kept between batches of one partition; beyond it the memory is emptied, results stay the same.
WORD_CACHE = 400_000
#: Words of more bytes than this are not kept between batches.
LONG_WORD = 200


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexBpe:
    """Encodes many words at once.

    All words of a batch lie end to end in one array of symbols with links to the left and right neighbour. An index
    maps each mergeable pair to all its positions in the batch. Ranks are taken in ascending order; all positions of the
    pair are merged from left to right, and only the lists of the pairs that arise beside a merge are extended.
    A pair that holds a merged symbol always has a higher rank than the merge that made the symbol, so no rank is met again
    after it was applied.
    """

    def __init__(self, spec: str, pattern: str):
        model = json.loads(spec)["model"]
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        self.byte_id = [0] * 256
        for ch, b in alphabet.items():
            self.byte_id[b] = vocab[ch]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[vocab[a], vocab[b]] = r
            self.made.append(vocab[a + b])
        self.words = regex.compile(pattern)
        self.known: dict[str, list[int]] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The token ids of each word."""
        sym: list[int] = []
        starts: list[int] = []
        byte_id, rank, made = self.byte_id, self.rank, self.made
        for w in words:
            starts.append(len(sym))
            sym += [byte_id[b] for b in w.encode("utf-8", "surrogatepass")]
            sym.append(-1)  # no pair holds -1, so nothing merges across words
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        index: dict[int, list[int]] = {}
        get = rank.get
        for i in range(n - 1):
            if (r := get((sym[i], sym[i + 1]))) is not None:
                if r in index:
                    index[r].append(i)
                else:
                    index[r] = [i]
        active = list(index)
        heapq.heapify(active)
        pair_of = self.pair_of
        while active:
            r = heapq.heappop(active)
            a, b = pair_of[r]
            new = made[r]
            positions = index.pop(r)
            positions.sort()
            for i in positions:
                j = right[i]
                if sym[i] != a or j >= n or sym[j] != b:
                    continue  # a merge to its left or right has used one of its symbols
                sym[i], sym[j] = new, -2
                k = right[j]
                right[i] = k
                if k < n:
                    left[k] = i
                    if (q := get((new, sym[k]))) is not None:
                        if q in index:
                            index[q].append(i)
                        else:
                            index[q] = [i]
                            heapq.heappush(active, q)
                h = left[i]
                if h >= 0 and (q := get((sym[h], new))) is not None:
                    if q in index:
                        index[q].append(h)
                    else:
                        index[q] = [h]
                        heapq.heappush(active, q)
        ends = [*starts[1:], n] if words else []
        return [[s for s in sym[a : b - 1] if s >= 0] for a, b in zip(starts, ends, strict=True)]

    @property
    def pair_of(self) -> list[tuple[int, int]]:
        if not hasattr(self, "_pairs"):
            self._pairs = list(self.rank)
        return self._pairs

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Token ids of each text; null and empty texts give no ids."""
        split = [self.words.findall(t) if t else [] for t in texts]
        known = self.known
        fresh = list({w for ws in split for w in ws if w not in known})
        once: dict[str, list[int]] = {}
        for w, ids in zip(fresh, self.encode_words(fresh), strict=True):
            (once if len(w) > LONG_WORD else known)[w] = ids
        out = []
        for ws in split:
            ids: list[int] = []
            for w in ws:
                ids += known[w] if w in known else once[w]
            out.append(ids)
        if len(known) > WORD_CACHE:
            known.clear()
        return out


def _bpe(spec) -> PairIndexBpe:
    import public_tokenizers

    return PairIndexBpe(spec.value, public_tokenizers.PATTERN)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str | None = None, count_only: bool = False) -> DataFrame:
    """``df`` with ``ids``, the token ids (array of int) of ``text``; with count_only their number (int).

    No special token is added, and the text of a special token is ordinary text. A null or an empty text has an empty
    array (0), never null. Any length of text is encoded whole. Other columns pass through; a column named like ``ids``
    is replaced. An empty table gives no rows.

    tokenizer: path of a byte-level BPE in JSON on the driver; its text (1.5 MB) is broadcast.
    """
    spark = df.sparkSession
    with open(tokenizer or default_path(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    df = df.drop(ids)
    kind = T.IntegerType() if count_only else T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*df.schema.fields, T.StructField(ids, kind, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for b in batches:
            bpe = bpe or _bpe(spec)
            got = bpe.encode_batch(b.column(b.schema.get_field_index(text)).to_pylist())
            made = pa.array(map(len, got), pa.int32()) if count_only else pa.array(got, pa.list_(pa.field("element", pa.int32(), False)))
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, ids])

    return df.mapInArrow(run, schema)
