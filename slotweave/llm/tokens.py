"""Token counts by overlap resynchronisation.

Short texts are encoded as they are. A huge text is cut into chunks that overlap;
each chunk is encoded with the offsets of its tokens. Two neighbours are spliced
at a boundary that both encodings have and that is proven stable: a space after
a character that is none. No piece of the vocabulary has a space after another
character (checked when the model is loaded), so no merge crosses such a place
and what lies on either side is encoded independently. An overlap without one is
widened until one is found or the text ends.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_FILE = "piece_bpe_32k.model"
CHUNK = 16_384
OVERLAP = 256
SLICE = 256
SPACE = "▁"  # as the model writes it
MARK = SPACE.encode()


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL_FILE)


@lru_cache
def processor(path: str):
    """The library's encoder, if splices at spaces are safe with it."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules = model.normalizer_spec
    crossing = [p.piece for p in model.pieces if SPACE in p.piece.lstrip(SPACE) and p.type == p.NORMAL]
    if crossing or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
        raise ValueError(f"{path}: a piece or a rule reaches over the start of a word; chunks can't be spliced there")
    return sentencepiece.SentencePieceProcessor(model_file=path)


def stable(raw: bytes, at: int) -> bool:
    """Whether no token can reach over the place before raw[at]: a space stands there, and none before it."""
    before = raw[at - 1 : at] == b" " or raw[at - 3 : at] == MARK
    return 0 < at < len(raw) and not before and (raw[at : at + 1] == b" " or raw[at : at + 3] == MARK)


def _cut(raw: bytes, at: int) -> int:
    """The place itself, or the start of the character it is in."""
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(raw))


def _encoded(sp, raw: bytes, start: int, end: int) -> list[int]:
    """Where each token of raw[start:end] begins, in bytes of the text."""
    return [start + p.begin for p in sp.encode(raw[start:end].decode(), return_type="proto").pieces]


def count_long(sp, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of a text of any length, chunk by chunk (sizes in bytes)."""
    raw = text.encode()
    total, start, splice = 0, 0, 0
    end = _cut(raw, chunk + overlap)
    begins = _encoded(sp, raw, 0, end)
    while end < len(raw):
        nxt, width = _cut(raw, start + chunk), overlap
        after_end = _cut(raw, max(nxt + chunk, end) + overlap)
        after = _encoded(sp, raw, nxt, after_end)
        while not (common := _common(raw, begins, after, nxt, end)) and end < len(raw):
            width *= 2
            end = _cut(raw, nxt + width)
            begins = _encoded(sp, raw, start, end)
            if end > after_end - overlap:
                after_end = _cut(raw, end + overlap)
                after = _encoded(sp, raw, nxt, after_end)
        if not common:
            break  # the left chunk now reaches the end of the text
        total += common[0] - splice
        splice, begins, start, end = common[1], after, nxt, after_end
    return total + len(begins) - splice


def _common(raw: bytes, left: list[int], right: list[int], low: int, high: int) -> tuple[int, int] | None:
    """Token numbers, in both encodings, of the first stable place inside (low, high) where both have a boundary."""
    first = {}
    for k in range(len(left) - 1, -1, -1):
        if left[k] <= low:
            break
        first[left[k]] = k
    for k, at in enumerate(right):
        if low < at < high and at in first and stable(raw, at):
            return first[at], k
    return None


def counted(docs: DataFrame, path: str | None = None, limit: int = 4096, chunk: int = CHUNK) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of docs(id, text); a null or empty text has 0 bytes and 0 tokens.

    Texts over `chunk` are counted in overlapping chunks, none is cut. Repeated rows are counted each, a null
    id stays null, an empty table stays empty, and other columns are not read.
    """
    path = path or model_path()

    def run(batches):
        sp = processor(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                piece = batch.slice(at, SLICE)
                texts = [t or "" for t in piece.column("text").to_pylist()]
                short = [i for i, t in enumerate(texts) if len(t) <= chunk]
                n = [0] * len(texts)
                for i, ids in zip(short, sp.encode([texts[i] for i in short], num_threads=1)):
                    n[i] = len(ids)
                for i in set(range(len(texts))).difference(short):
                    n[i] = count_long(sp, texts[i], chunk)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("n_bytes"), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"]
                )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    told = docs.select("id", "text", size).mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return told.withColumn("over_limit", F.col("n_tokens") > limit)
