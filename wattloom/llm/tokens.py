"""Token ids of whole texts, by the tokenizers library, with a cache of pieces.

A text is cut at places where the tokenizer itself always cuts, whatever stands
around them, and each different piece is encoded once by the library; a text's
ids are the ids of its pieces.  The safe places depend on the tokenizer's
pre-tokenizer, so each known kind has its own rule; any other tokenizer encodes
whole texts.

byte-level pieces: cut before a space or line feed that follows a visible ASCII
character or a Latin letter, after a single line feed before a letter, and
between a letter and an ASCII punctuation mark other than the apostrophe.
word pieces: white space is dropped by the tokenizer, so it separates pieces;
cut also between a letter and an ASCII punctuation mark other than the
apostrophe.
"""

from __future__ import annotations

import os

import numpy as np

from .kernels import BYTE_VALUES, RangeHasher, U64, ragged, text_blocks

_SLOTS = 1 << 19  # pieces that the cache of an encoder holds
_POOL = 1 << 21  # their ids

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = True
_LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, dtype=bool)
for _c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~":
    _MARK[ord(_c)] = True
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True


def _classes(buf: np.ndarray):
    """For each byte: does a letter start here, does one end here (ASCII and U+00C0-U+00FF letters)."""
    n = len(buf)
    begins, ends = _LETTER[buf], _LETTER[buf]
    lead = np.flatnonzero(buf[: max(0, n - 1)] == 0xC3)
    second = buf[lead + 1]
    lead = lead[(second >= 0x80) & (second != 0x97) & (second != 0xB7)]
    begins[lead] = True
    ends[lead + 1] = True
    return begins, ends


def cut_bytes(buf: np.ndarray, offs: np.ndarray, letters: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces for a byte-level tokenizer; they cover every byte."""
    n = len(buf)
    cut = np.zeros(n, dtype=bool)
    begins, ends = letters
    solid = _VISIBLE[buf] | ends
    gap = (buf == 0x20) | (buf == 0x0A)
    mark = _MARK[buf]
    cut[1:] = (gap[1:] & solid[:-1]) | (ends[:-1] & mark[1:]) | (mark[:-1] & begins[1:])
    cut[2:] |= begins[2:] & (buf[1:-1] == 0x0A) & solid[:-2]
    cut[offs[:-1][offs[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], n)


def cut_words(buf: np.ndarray, offs: np.ndarray, letters: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces for a tokenizer that drops white space."""
    n = len(buf)
    begins, ends = letters
    mark = _MARK[buf]
    inside = (buf != 0x20) & ((buf < 0x09) | (buf > 0x0D))
    edge = np.zeros(n + 1, dtype=bool)  # a piece may begin or end at this place
    edge[1:n] = (inside[1:] != inside[:-1]) | (ends[:-1] & mark[1:]) | (mark[:-1] & begins[1:])
    edge[offs] = True
    at = np.flatnonzero(edge)
    starts, stops = at[:-1], at[1:]
    keep = inside[starts]
    return starts[keep], stops[keep]


class Encoder:
    """ids of many texts; one for each process and tokenizer file."""

    slots, pool_size = _SLOTS, _POOL
    _known: dict[tuple, Encoder] = {}

    @classmethod
    def of(cls, path: str, plain_specials: bool = False) -> Encoder:
        """plain_specials: the strings of special tokens are ordinary text."""
        if (path, plain_specials) not in cls._known:
            cls._known[path, plain_specials] = cls(path, plain_specials)
        return cls._known[path, plain_specials]

    def __init__(self, path: str, plain_specials: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t["content"].encode() for t in json.load(open(path))["added_tokens"]]
        self.cut = self._rule(json.loads(self.tokenizer.to_str()))
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.token_bytes = np.zeros(size, dtype=np.int64)
        self.token_ends = np.zeros(size, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = len(token)  # a byte-level token has one character for each byte
            self.token_ends[i] = token.endswith("</w>")
        self._clear()

    @staticmethod
    def _rule(about: dict):
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in about["added_tokens"])
        pre, norm = about["pre_tokenizer"] or {}, about["normalizer"] or {}
        if not plain or about["model"]["type"] != "BPE" or about["post_processor"]:
            return None
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not norm:
            return cut_bytes
        steps = [p["type"] for p in pre.get("pretokenizers", [])]
        kinds = [x["type"] for x in norm.get("normalizers", [])]
        if steps == ["Split", "ByteLevel"] and kinds == ["NFC", "Replace", "Lowercase"] and pre["pretokenizers"][0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}:
            return cut_words
        return None

    def _clear(self) -> None:
        self.keys = np.zeros(self.slots, dtype=U64)
        self.begin = np.zeros(self.slots, dtype=np.int32)
        self.length = np.zeros(self.slots, dtype=np.int32)
        self.pool = np.zeros(self.pool_size, dtype=np.uint32)
        self.used = 0

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each text, flat, and the number of each."""
        parts, lengths = [np.zeros(0, np.uint32)], []
        for i in range(0, len(texts), 2000):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False):
                ids = e.ids
                lengths.append(len(ids))
                parts.append(np.array(ids, dtype=np.uint32))
        return np.concatenate(parts), np.array(lengths, dtype=np.int64)

    def _encode_joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for pieces that can stand in one text: where each ends is known from its tokens."""
        join = b"" if self.cut is cut_bytes else b" "
        flat, _ = self._encode([join.join(pieces[i : i + 500]).decode() for i in range(0, len(pieces), 500)])
        if self.cut is cut_bytes:
            stops = np.searchsorted(np.cumsum(self.token_bytes[flat]), np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))) + 1
            sound = int(self.token_bytes[flat].sum()) == sum(map(len, pieces))
        else:
            stops = np.flatnonzero(self.token_ends[flat]) + 1
            sound = len(stops) == len(pieces)
        return (flat, np.diff(stops, prepend=0)) if sound else None

    def _learn(self, buf: np.ndarray, letters: tuple, starts: np.ndarray, ends: np.ndarray, h: np.ndarray):
        """Encode pieces that the cache does not hold; their ids, flat, and lengths."""
        raw = buf.tobytes()
        pieces = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        letter_begins, letter_ends = letters
        if self.cut is cut_bytes:
            easy = (buf[starts] == 0x20) & (ends - starts > 1) & (letter_ends | _VISIBLE[buf])[ends - 1]
        else:
            odd = np.concatenate([[0], np.cumsum(~(letter_begins | letter_ends))])
            easy = odd[ends] == odd[starts]
        flat, lengths = np.zeros(0, np.uint32), np.zeros(len(pieces), np.int64)
        simple, rest = np.flatnonzero(easy), np.flatnonzero(~easy)
        found = self._encode_joined([pieces[k] for k in simple.tolist()]) if len(simple) else None
        if found is None:
            simple, rest = simple[:0], np.arange(len(pieces))
            found = flat, lengths[:0]
        others, other_lengths = self._encode([pieces[k].decode("utf-8", "replace") for k in rest.tolist()])
        lengths[simple], lengths[rest] = found[1], other_lengths
        from_where = np.zeros(len(pieces), np.int64)
        from_where[simple] = np.cumsum(found[1]) - found[1]
        from_where[rest] = len(found[0]) + np.cumsum(other_lengths) - other_lengths
        flat = np.concatenate([found[0], others])[ragged(from_where, lengths)]
        if self.used + len(flat) > self.pool_size:
            self._clear()
        if len(flat) <= self.pool_size:
            begin = self.used + np.cumsum(lengths) - lengths
            self.pool[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            slot = (h % U64(self.slots)).astype(np.int64)
            self.keys[slot], self.begin[slot], self.length[slot] = h, begin, lengths
        return flat, lengths

    def block(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents of a block, flat, and the number of each."""
        if self.cut is None or any(s in buf.tobytes() for s in self.specials):
            return self._encode([buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)])
        letters = _classes(buf)
        starts, ends = self.cut(buf, offs, letters)
        h = RangeHasher(BYTE_VALUES[buf])(starts, ends)
        slot = (h % U64(self.slots)).astype(np.int64)
        hit = self.keys[slot] == h
        begin, length, pool = self.begin[slot].astype(np.int64), self.length[slot].astype(np.int64), self.pool
        miss = np.flatnonzero(~hit)
        if len(miss):
            _, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            one = miss[first]
            at = ragged(begin[hit], length[hit])
            kept = pool[at]  # before learning may clear the pool
            flat, lengths = self._learn(buf, letters, starts[one], ends[one], h[one])
            base = np.cumsum(lengths) - lengths
            begin[hit] = np.cumsum(length[hit]) - length[hit]
            begin[miss] = len(kept) + base[back]
            length[miss] = lengths[back]
            pool = np.concatenate([kept, flat])
        ids = pool[ragged(begin, length)]
        total = np.concatenate([[0], np.cumsum(length)])
        edges = total[np.searchsorted(starts, offs)]
        return ids, np.diff(edges)

    def column(self, column):
        """Yield (first row, end row, ids, counts) for the texts of an Arrow column."""
        for i, j, buf, offs in text_blocks(column):
            yield i, j, *self.block(buf, offs)
