"""Token ids of whole texts, in Arrow batches, from a file of the ``tokenizers`` library."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Bytes of text that are encoded at once, and words whose ids a task remembers: together some 100 MB a task.
CHUNK_BYTES, REMEMBERED = 2_000_000, 200_000


#: Letters and digits beside which a sign of ASCII, but for the apostrophe, always begins or ends a token.
_LETTER, _SIGN = "[a-z0-9À-ÖØ-öø-ÿ]", r"[!-&(-/:-@\[-`{-~]"


class WordEncoder:
    """Encodes texts whose tokens never span white space, looking up each distinct word of a batch once.

    The result is that of ``Tokenizer.encode(text, add_special_tokens=False)``, for a tokenizer that lower-cases,
    drops white space and parts letters from signs. Words of ASCII letters and runs of signs go straight to
    its model, other words through all of it; so do whole texts in which a special token can stand.
    """

    _plain = re.compile(rf"[a-z]+|[0-9]|{_SIGN}+").fullmatch

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in one array, and the number of ids of each text; null texts have none."""
        texts = pc.fill_null(texts, "")
        special = np.zeros(len(texts), bool)
        for token in self._special:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        lower = pc.if_else(pa.array(special), "", pc.ascii_lower(texts)).cast(pa.large_string())
        parted = pc.replace_substring_regex(lower, f"({_LETTER})({_SIGN})", r"\1 \2")
        parted = pc.replace_substring_regex(parted, f"({_SIGN})({_LETTER})", r"\1 \2")
        words = pc.ascii_split_whitespace(parted)
        coded = words.flatten().dictionary_encode()
        parts = self._look_up(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(parts), np.uint16 if self._tokenizer.get_vocab_size() <= 2**16 else np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // flat.itemsize
        starts = np.cumsum(lengths) - lengths
        index = coded.indices.to_numpy(zero_copy_only=False)
        each = lengths[index]
        ends = np.cumsum(each)
        ids = flat[np.repeat(starts[index] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)].astype(np.uint32)
        bounds = np.concatenate(([0], ends))[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return self._with_special(texts, special, ids, bounds)

    def _with_special(self, texts: pa.Array, special: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts in the ids of the texts that were left out for their special tokens."""
        counts = np.diff(bounds)
        rows = np.flatnonzero(special)
        if len(rows):
            pieces, last = [], 0
            for row in rows:
                own = self._tokenizer.encode(texts[int(row)].as_py(), add_special_tokens=False).ids
                pieces += [ids[last : bounds[row]], np.array(own, np.uint32)]
                counts[row], last = len(own), bounds[row]
            ids = np.concatenate([*pieces, ids[last:]])
        return ids, counts

    def _look_up(self, words: list[str]) -> list[bytes]:
        kind = np.uint16 if self._tokenizer.get_vocab_size() <= 2**16 else np.uint32
        known, plain, tokenize = self._known, self._plain, self._model.tokenize
        out = [known.get(word) for word in words]
        missing = [i for i, ids in enumerate(out) if ids is None]
        odd = []
        for i in missing:
            if plain(words[i]):
                out[i] = array(kind().dtype.char, [token.id for token in tokenize(words[i])]).tobytes()
            else:
                odd.append(i)
        for i, encoding in zip(odd, self._tokenizer.encode_batch_fast([words[i] for i in odd], add_special_tokens=False)):
            out[i] = np.array(encoding.ids, kind).tobytes()
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
        known.update((words[i], out[i]) for i in missing[:REMEMBERED])
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs, so that its memory does not grow with them."""
    return WordEncoder(path)


def chunks(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``CHUNK_BYTES`` of text, of one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes) // CHUNK_BYTES
    edges = [0, *(np.flatnonzero(np.diff(parts)) + 1), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield batch.slice(low, high - low)
