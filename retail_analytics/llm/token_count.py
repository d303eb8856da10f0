"""Token counts by heap-and-linked-list byte-pair merging: initial symbols minus merges, no identifiers."""
from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pick, texts_of

#: Fixed value: the byte-level pre-tokenisation of the public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 1 << 20                    # distinct words whose count a worker remembers


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def load_merges(path: str) -> dict:
    """{"first": symbol of each byte, "merges": {left << 32 | right: (rank, new symbol)}, "special": [...]} of a tokenizers file."""
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    ids = t["model"]["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in t["model"]["merges"]]
    merges: dict[int, tuple[int, int]] = {}
    for rank, (a, b) in enumerate(pairs):
        merges.setdefault(ids[a] << 32 | ids[b], (rank, ids[a + b]))
    return {"first": [ids[c] for c in byte_symbols()], "merges": merges, "special": [x["content"] for x in t.get("added_tokens", [])], "memo": {}}


def count_merged(word: bytes, first: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """Symbols left after all merges of one word.  The heap holds (rank, left position) of adjacent pairs, the lists link the
    living symbols; an entry whose pair has changed meanwhile is skipped."""
    symbols = [first[b] for b in word]
    n = len(symbols)
    if n < 2:
        return n
    heap = []
    for i in range(n - 1):
        pair = merges.get(symbols[i] << 32 | symbols[i + 1])
        if pair:
            heap.append((pair[0], i, pair[1]))
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    left = n
    while heap:
        rank, i, new = heapq.heappop(heap)
        if symbols[i] < 0 or (j := after[i]) >= n or (pair := merges.get(symbols[i] << 32 | symbols[j])) is None or pair[0] != rank:
            continue
        symbols[i], symbols[j] = new, -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if pair := merges.get(new << 32 | symbols[k]):
                heapq.heappush(heap, (pair[0], i, pair[1]))
        if (k := before[i]) >= 0 and (pair := merges.get(symbols[k] << 32 | new)):
            heapq.heappush(heap, (pair[0], k, pair[1]))
    return left


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    vocabulary: path of a byte-level BPE file for the tokenizers library; the driver reads it.  A special token inside a text
    counts as one token, as by that library's default; none is added.  Null and empty texts have 0 bytes and tokens; a long
    word costs n log n; repeated rows stay; an empty table gives an empty result; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_merges(vocabulary))
    source = pick(docs, doc_id=id_col, text=text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()

    def count(batches):
        own = shared.value
        first, merges, memo = own["first"], own["merges"], own["memo"]
        special, plain = set(own["special"]), regex.compile(PATTERN)
        cutter = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

        def of(text: str) -> int:
            pieces = cutter.split(text) if cutter and any(x in text for x in special) else (text,)
            total = 0
            for piece in pieces:
                if piece in special:
                    total += 1
                    continue
                for word in plain.findall(piece):
                    n = memo.get(word)
                    if n is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        n = count_merged(word.encode("utf-8"), first, merges)
                        if len(word) <= 64:
                            memo[word] = n
                    total += n
            return total

        for b in batches:
            texts = texts_of(b)
            n = [of(t.decode("utf-8")) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()),
                                              pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
