"""Token ids of texts, computed a distinct word at a time.

The tokenizers this serves drop or fold white space and never join across it, so a
text's ids are those of its space-separated pieces in order.  Each slice of
text is cut into pieces, distinct pieces are looked up in a bounded store of
pieces seen before, the rest are encoded together, and the ids are gathered.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parcelflow.llm.words import text_bytes, word_hashes

#: Pieces remembered by one Python worker, about 50 bytes each; once there are as many,
#: others are encoded again in each slice.
STORE_PIECES = 400_000
#: Pieces encoded as one text, and texts in one call.
TOGETHER, CALL = 500, 16
_SECOND = 0xFF51AFD7ED558CCD


def load(path: str, literal_specials: bool = False):
    """The tokenizer of a file; ``literal_specials``: special strings in a text are
    ordinary text."""
    # A task has one core; threads of its own would only add memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = literal_specials
    return tokenizer


class PieceEncoder:
    def __init__(self, path: str, literal_specials: bool = False) -> None:
        self.tokenizer = load(path, literal_specials)
        # Known pieces by their sorted hash: a second hash, and their ids in ``flat``.
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the pieces, their ids in it end to end, and the number of each.
        Pieces are encoded many at a time with a bar between them, which is a token of
        its own; a piece with a bar is encoded alone."""
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        bar = self.tokenizer.encode("|", add_special_tokens=False).ids
        alone = [i for i, p in enumerate(pieces) if "|" in p or len(bar) != 1]
        apart = set(alone)
        together = [i for i in range(len(pieces)) if i not in apart]
        order: list[int] = []
        flats = [np.zeros(0, np.uint32)]
        sizes = [np.zeros(0, np.int32)]
        for at in range(0, len(together), TOGETHER * CALL):
            groups = [
                together[i : i + TOGETHER]
                for i in range(at, min(at + TOGETHER * CALL, len(together)), TOGETHER)
            ]
            joined = [" | ".join([pieces[i] for i in g]) for g in groups]
            for group, encoding in zip(groups, encode(joined, add_special_tokens=False), strict=True):
                ids = np.array(encoding.ids, np.uint32)
                bars = ids == bar[0]
                cuts = np.flatnonzero(bars)
                if len(cuts) + 1 != len(group):
                    alone += group
                    continue
                order += group
                flats.append(ids[~bars])
                sizes.append((np.diff(np.r_[-1, cuts, len(ids)]) - 1).astype(np.int32))
        for at in range(0, len(alone), TOGETHER):
            part = [pieces[i] for i in alone[at : at + TOGETHER]]
            for encoding in encode(part, add_special_tokens=False):
                flats.append(np.array(encoding.ids, np.uint32))
                sizes.append(np.array([len(encoding.ids)], np.int32))
        return np.array(order + alone, np.int64), np.concatenate(flats), np.concatenate(sizes)

    def _look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each distinct piece start, their number, and the array they
        lie in."""
        raw, off = text_bytes(pieces)
        keys = word_hashes(raw, off[:-1], off[1:])
        checks = word_hashes(raw, off[:-1], off[1:], _SECOND)
        starts, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        have = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            have = (self.keys[at] == keys) & (self.checks[at] == checks)
            starts[have], sizes[have] = self.starts[at[have]], self.sizes[at[have]]
        missing = np.flatnonzero(~have)
        if not len(missing):
            return starts, sizes, self.flat
        order, flat, number = self._encode(pieces.take(pa.array(missing)).to_pylist())
        missing = missing[order]
        sizes[missing] = number
        starts[missing] = len(self.flat) + np.cumsum(number, dtype=np.int64) - number
        flat = np.concatenate([self.flat, flat])
        if len(self.keys) + len(missing) <= STORE_PIECES:
            self.flat = flat
            new = missing[np.argsort(keys[missing], kind="stable")]
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.checks = np.insert(self.checks, at, checks[new])
            self.starts = np.insert(self.starts, at, starts[new].astype(np.int32))
            self.sizes = np.insert(self.sizes, at, sizes[new].astype(np.int32))
        return starts, sizes, flat

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end (uint32), and each row's number of ids."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        pieces = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        rows = np.repeat(np.arange(len(column)), np.diff(np.asarray(pieces.offsets)))
        coded = pieces.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        starts, sizes, store = self._look_up(coded.dictionary)
        starts, sizes = starts[which], sizes[which]
        total = int(sizes.sum())
        before = np.cumsum(sizes) - sizes
        flat = store[np.repeat(starts - before, sizes) + np.arange(total)]
        counts = np.bincount(rows, weights=sizes, minlength=len(column)).astype(np.int64)
        return flat, counts


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, literal_specials: bool = False) -> PieceEncoder:
    """The encoder of this Python worker: loaded once, and what it remembers serves the
    tasks that follow."""
    key = path, literal_specials
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, literal_specials)
    return _encoders[key]
