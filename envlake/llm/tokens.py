"""Byte-level BPE ids of whole texts, through the tokenizers library."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from envlake.llm.common import give_back, text_bytes
from envlake.llm.shingles import mix

END = 0  # the id that closes a document
MOST_REMEMBERED = 400_000  # pieces; the rare ones are forgotten when there are more
FREQUENT = 20  # uses of a piece that is kept from task to task
SOME = 1 << 17  # pieces looked up at once
SLICE = 1 << 18  # bytes of text encoded at once
SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS
#: The first n bytes of a little-endian whole number.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

# Byte-level BPE first cuts a text into pre-tokens and encodes each alone. Over the letters
# below, ASCII without apostrophes, blanks and line breaks, pre-tokens are runs of letters, of
# digits or of other signs, each with the blank before it, and what is left of white space.
# Other texts are cut only where a blank precedes a visible character: that always opens a
# pre-token, as a run of white space leaves its last blank to the word after it.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
CUT = re.compile(r"(?= [!-~¡-ɏ])")
PLAIN = re.compile(rf" [{LETTERS}]+")

BLANK_CLASS, BREAK_CLASS, BAD_CLASS = 4, 5, 6


def _byte_classes() -> np.ndarray:
    """1 letter, 2 digit, 3 sign, then the classes above; bytes of UTF-8."""
    out = np.full(256, BAD_CLASS, np.uint8)
    out[33:127] = 3
    out[[*range(65, 91), *range(97, 123)]] = 1
    out[48:58] = 2
    out[32], out[10], out[39] = BLANK_CLASS, BREAK_CLASS, BAD_CLASS
    out[0x80:0xC0] = 1  # what follows the first byte of a letter
    out[0xC3:0xC9] = 1  # U+00C0 to U+023F
    return out


CLASSES = _byte_classes()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceMemo:
    """Ids of byte pieces, each encoded once by :meth:`fresh` and remembered."""

    most = MOST_REMEMBERED

    def __init__(self) -> None:
        self.generation = 0
        self.forget()

    def fresh(self, wanted: list[str]) -> dict[str, bytes]:
        """Ids of the pieces as little-endian unsigned 32-bit bytes."""
        raise NotImplementedError

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Place in ``self.start`` of each piece, after encoding those not met before."""
        known = self.known
        fresh = [w for w in dict.fromkeys(pieces) if w not in known]
        if len(known) + len(fresh) > self.most and known:
            self.forget_rare()
            return self._numbers(pieces)
        if fresh:
            names = [w.decode() for w in fresh]
            found = self.fresh(names)
            data = [found[n] for n in names]
            lengths = np.fromiter(map(len, data), np.int64, len(data)) // 4
            flat = np.frombuffer(b"".join(data), "<u4")
            self._append(flat, lengths)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.used = self.pieces = 0
        self.arena = np.empty(1 << 16, np.uint32)
        self.start, self.length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int32)
        # the last piece met of each slot: its bytes as whole numbers, its length, its number
        self.slot_bytes = np.zeros((3, SLOTS), np.uint64)
        self.slot_size = np.full(SLOTS, -1, np.int32)
        self.slot_number = np.zeros(SLOTS, np.int32)

    def rest(self) -> None:
        """Forget all but frequent pieces: workers that wait for their next task hold little."""
        self.forget_rare(FREQUENT)
        give_back()

    def forget_rare(self, least: int = 2) -> None:
        """Forget pieces met less often since the last time, and all if that frees too little."""
        names, uses = list(self.known), self.uses[: self.pieces]
        keep = np.flatnonzero(uses >= least)
        if len(keep) > self.most // 2:
            keep = keep[:0]
        length = self.length[keep]
        before = np.cumsum(length) - length
        flat = self.arena[np.repeat(self.start[keep] - before, length) + np.arange(int(length.sum()))]
        names = [names[i] for i in keep.tolist()]
        self.forget()
        self._append(flat, length)
        self.known = dict(zip(names, range(len(names)), strict=True))
        self.generation += 1

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        def grown(array: np.ndarray, need: int) -> np.ndarray:
            return array if need <= len(array) else np.resize(array, max(need, 2 * len(array)))

        n = len(lengths)
        self.uses = grown(self.uses, self.pieces + n)
        self.uses[self.pieces : self.pieces + n] = 0
        self.arena = grown(self.arena, self.used + len(flat))
        self.start, self.length = grown(self.start, self.pieces + n), grown(self.length, self.pieces + n)
        self.arena[self.used : self.used + len(flat)] = flat
        self.start[self.pieces : self.pieces + n] = self.used + np.cumsum(lengths) - lengths
        self.length[self.pieces : self.pieces + n] = lengths
        self.used, self.pieces = self.used + len(flat), self.pieces + n

    def ids(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and the number of ids of each.

        Most pieces are found in a table of slots, where all of their bytes are compared;
        the others, and those of more than 24 bytes, in the dictionary.
        """
        parts = [self._some_ids(raw, starts[i : i + SOME], ends[i : i + SOME]) for i in range(0, len(starts), SOME)]
        if not parts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _some_ids(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low_, high_ = int(starts[0]), int(ends[-1])
        raw, starts, ends = raw[low_:high_], starts - low_, ends - low_
        sizes = ends - starts
        padded = np.concatenate([raw, np.zeros(24, np.uint8)])
        words = np.ndarray((len(raw) + 17,), "<u8", padded, 0, (1,))  # eight bytes from each place on
        # bytes 0 to 7, 8 to 15 and 16 to 23 as whole numbers; few pieces have the latter two
        key = words[starts] & MASKS[np.minimum(sizes, 8)]
        mixed = key ^ sizes.astype(np.uint64)
        longer = []
        for k in (1, 2):
            some = np.flatnonzero(sizes > 8 * k)
            part = words[starts[some] + 8 * k] & MASKS[np.minimum(sizes[some] - 8 * k, 8)]
            mixed[some] ^= part * MULTIPLIERS[k - 1]
            longer.append((some, part))
        slot = (mix(mixed) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        number = self.slot_number[slot]
        hit = (self.slot_size[slot] == sizes) & (self.slot_bytes[0][slot] == key)
        for held, (some, part) in zip(self.slot_bytes[1:], longer, strict=True):
            hit[some] &= held[slot[some]] == part
        missed = np.flatnonzero(~hit)
        if len(missed):
            view = memoryview(raw)
            low, high = starts[missed].tolist(), ends[missed].tolist()
            pieces = [bytes(view[a:b]) for a, b in zip(low, high, strict=True)]
            before = self.generation
            found = self._numbers(pieces)
            if before != self.generation:  # all was forgotten: numbers from the slots are void
                return self._some_ids(raw, starts, ends)
            number[missed] = found
            self.slot_size[slot[missed]] = np.where(sizes[missed] <= 24, sizes[missed], -1)
            self.slot_bytes[0][slot[missed]] = key[missed]
            for held, (some, part) in zip(self.slot_bytes[1:], longer, strict=True):
                new = ~hit[some]
                held[slot[some[new]]] = part[new]
            self.slot_number[slot[missed]] = number[missed]
        self.uses[: self.pieces] += np.bincount(number, minlength=self.pieces)
        at, length = self.start[number], self.length[number]
        first = np.cumsum(length) - length
        return self.arena[np.repeat(at - first, length) + np.arange(int(length.sum()))], length


class Encoder(PieceMemo):
    """Ids of whole texts. Equal pieces of a batch are encoded once, and remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        super().__init__()
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that begin with a blank
        for token, number in self.tokenizer.get_vocab().items():
            self.opens[number] = token.startswith("Ġ")

    def fresh(self, wanted: list[str]) -> dict[str, bytes]:
        """Words after a blank are encoded in a row and told apart by their blanks."""
        plain = [w for w in wanted if PLAIN.fullmatch(w)]
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(plain)], add_special_tokens=False)[0].ids, "<u4")
        bounds = (np.append(np.flatnonzero(self.opens[ids]), len(ids)) * 4).tolist()
        data = ids.tobytes()
        out = {}
        if len(bounds) == len(plain) + 1:
            out = {w: data[a:b] for w, a, b in zip(plain, bounds, bounds[1:], strict=False)}
        others = [w for w in wanted if w not in out]
        found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        out.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(others, found, strict=True))
        return out

    def _by_cuts(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast(CUT.split(text), add_special_tokens=False)
        return b"".join(np.array(e.ids, "<u4").tobytes() for e in found)

    def _with_added(self, raw: np.ndarray, offsets: np.ndarray) -> set[int]:
        """The texts that hold the string of an added token, which the library makes one id."""
        data, found = raw.tobytes(), set()
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(token) <= offsets[i + 1]:
                    found.add(i)
                at = data.find(token, at + 1)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by ``END``, and the n + 1 offsets; null is empty."""
        raw, offsets = text_bytes(texts)
        n_texts = len(offsets) - 1
        kind = CLASSES[raw]
        bad = kind == BAD_CLASS
        signs = np.flatnonzero((raw == 0x97) | (raw == 0xB7))  # the signs among the letters
        bad[signs[(signs > 0) & (raw[signs - 1] == 0xC3)]] = True
        odd = np.diff(np.searchsorted(np.flatnonzero(bad), offsets)) > 0
        whole = self._with_added(raw, offsets)
        odd[list(whole)] = True

        starts, ends, owner = self._pre_tokens(raw, offsets, kind)
        good = ~odd[owner]
        starts, ends, owner = starts[good], ends[good], owner[good]
        ids, length = self.ids(raw, starts, ends)
        per_text = np.bincount(owner, weights=length, minlength=n_texts).astype(np.int64)
        if odd.any():
            edges = np.r_[0, np.cumsum(per_text)]
            parts = [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            for i in np.flatnonzero(odd):
                text = texts[int(i)].as_py()
                if i in whole:
                    parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
                else:
                    parts[i] = np.frombuffer(self._by_cuts(text), "<u4")
            per_text = np.fromiter(map(len, parts), np.int64, n_texts)
            ids = np.concatenate(parts)
        ends_ = np.cumsum(per_text)
        return np.insert(ids, ends_, END), np.r_[0, ends_ + np.arange(1, n_texts + 1)]

    @staticmethod
    def _pre_tokens(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens, and the text of each."""
        n = len(raw)
        if not n:
            none = np.empty(0, np.int64)
            return none, none, none
        space = (kind == BLANK_CLASS) | (kind == BREAK_CLASS)
        opens_text = np.zeros(n + 1, bool)
        opens_text[offsets] = True
        before = np.r_[np.uint8(0), kind[:-1]]
        before[opens_text[:-1]] = 0
        spaced = (before == BLANK_CLASS) | (before == BREAK_CLASS)
        visible_next = np.r_[~space[1:], False] & ~opens_text[1:]
        start = ~space & (kind != before) & (before != BLANK_CLASS)
        start |= space & (visible_next | ~spaced)
        start |= opens_text[:-1]
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)
        return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def kept(kind: type, path: str):
    """``kind(path)`` of this Python worker, kept from task to task."""
    store = vars(sys.modules.setdefault("_envlake_kept", types.ModuleType("_envlake_kept")))
    key = f"{kind.__name__} {path}"
    if key not in store:
        store[key] = kind(path)
    return store[key]


def encoder(path: str, most: int = MOST_REMEMBERED) -> Encoder:
    """This worker's encoder, which from now on remembers ``most`` pieces, but at least those looked up at once."""
    memo = kept(Encoder, path)
    memo.most = max(most, SOME)
    return memo
