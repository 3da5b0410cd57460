"""Token counts of whole texts under a public byte-level BPE vocabulary.

Texts are encoded in Arrow batches and only lengths leave the task. Within a batch, texts are cut at
safe boundaries and grouped into calls of about equal bytes of UTF-8, so one very long text neither holds a
call of its own size nor is cut short. A call is one batch of each library.

Two libraries give the ids. Pieces made of printable ASCII, common white space and Latin letters are
encoded with ranks of the same vocabulary (several times faster); any other piece goes through the
``tokenizers`` file itself, because Unicode classes may differ between regular-expression engines.
Both give the same ids, which the tests check.

Nulls count as empty texts (0 bytes, 0 tokens). Extra columns are ignored, whatever their names. Repeated rows give
repeated rows; an empty table gives no rows; a null key stays null. A text without a space between solid characters
has no safe boundary and is a piece, and if it is long a call, of its own.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_buffer

#: Bytes of one call of the encoder.
CALL_BYTES = 1 << 18
#: A text is cut into pieces of about this many characters.
PIECE_CHARS = 1 << 16
#: A space between two characters that are not white space: a word of the pattern always begins there,
#: and no special string holds a space, so both sides encode as they do together.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PLAIN = re.compile(r"[\t\n\r\x20-\x7EÀ-ÖØ-öø-ɏ]*")
_loaded: dict[str, tuple] = {}


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cut ``text`` at the first safe boundary after each ``size`` characters; a text without any stays whole."""
    if len(text) <= size:
        return [text]
    out, at = [], 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    out.append(text[at:])
    return out


def _encoders(path: str):
    """(file's own tokenizer, the same vocabulary as ranks, special strings); loaded once per worker."""
    if path not in _loaded:
        import tiktoken
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.no_truncation()
        own.no_padding()
        spec = json.loads(own.to_str())
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pre = spec["pre_tokenizer"]
        plain = spec["normalizer"] is None and pre and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        ranks = None
        if plain and all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec["added_tokens"]):
            printable = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
            rest = [b for b in range(256) if b not in set(printable)]
            back = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
            words = {bytes(back[c] for c in w): i for w, i in own.get_vocab(with_added_tokens=False).items() if w not in special}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            ranks = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=words, special_tokens=special)
        _loaded[path] = own, ranks, set(special)
    return _loaded[path]


def count_lengths(texts: list[str], path: str) -> list[int]:
    """Token counts of ``texts``, none longer than a call should be."""
    own, ranks, special = _encoders(path)
    out = [0] * len(texts)
    plain = [k for k, text in enumerate(texts) if _PLAIN.fullmatch(text)] if ranks is not None else []
    if plain:
        for k, ids in zip(plain, ranks.encode_batch([texts[k] for k in plain], num_threads=1, allowed_special=special, disallowed_special=()), strict=True):
            out[k] = len(ids)
    done = set(plain)
    other = [k for k in range(len(texts)) if k not in done]
    if other:
        for k, found in zip(other, own.encode_batch_fast([texts[k] for k in other], add_special_tokens=False), strict=True):
            out[k] = len(found)
    return out


def calls(texts: list[str | None], most: int = CALL_BYTES) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, pieces) of calls: as many pieces as fit ``most`` bytes of UTF-8, at least one."""
    owner, call, held = [], [], 0
    for k, whole in enumerate(texts):
        for piece in pieces(whole) if whole else []:
            size = len(piece) if piece.isascii() else len(piece.encode("utf-8", "surrogatepass"))
            if call and held + size > most:
                yield owner, call
                owner, call, held = [], [], 0
            owner.append(k)
            call.append(piece)
            held += size
    if call:
        yield owner, call


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; ``tokenizer_path`` must exist on every executor."""
    prepare(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [0] * len(texts)
            for owner, call in calls(texts):
                for k, n in zip(owner, count_lengths(call, tokenizer_path), strict=True):
                    counts[k] += n
            _, off = text_buffer(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(off[1:] - off[:-1], pa.int64()), pa.array(counts, pa.int64())], names=["k", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    counted = rows.mapInArrow(encode, f"k {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
