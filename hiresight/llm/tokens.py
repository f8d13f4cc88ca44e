"""Token ids as the tokenizers library gives them, with a memo of words.

A byte-level BPE pre-tokenises a text before it merges bytes, and a boundary
always lies before a space that a non-space follows and around a single line
break.  Texts whose spaces and line breaks are all of that kind are therefore
encoded word by word, each distinct word and each distinct pre-token only once
per worker; every other text goes to the library whole.  Both give the same ids.
"""

from __future__ import annotations

import json
from array import array

from hiresight.llm.common import worker_state

#: white space other than spaces and line breaks
OTHER_SPACE = r"[^\S \n]"
MEMO_WORDS = 500_000


def byte_table() -> dict[int, int]:
    """Byte value (as latin-1) -> the printable stand-in of byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(other)}


class Memo(dict):
    """word -> value(word), in two halves: when the new one is full it becomes the old one.

    Words that come again move on to the new half, so what is dropped are words
    that haven't been met for a while; at most ``MEMO_WORDS`` are held."""

    def __init__(self, value):
        super().__init__()
        self.value, self.old = value, {}

    def __missing__(self, word):
        if len(self) >= MEMO_WORDS // 2:
            self.old = dict(self)
            self.clear()
        v = self.old.get(word)
        if v is None:
            v = self.value(word)
        self[word] = v
        return v


class Encoder:
    """Ids (or counts) of whole texts, without added special tokens."""

    def __init__(self, path: str, counts: bool):
        import re
        import sys

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                        and spec.get("normalizer") is None and model["type"] == "BPE"
                        and not any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix")))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.other_space, self.tok, self.counts = re.compile(OTHER_SPACE).search, tok, counts
        pieces, table, tokenize = regex.compile(public_tokenizers.PATTERN).findall, byte_table(), tok.model.tokenize
        swap, space = sys.byteorder != "little", chr(table[32])

        def pack(ids):
            if counts:
                return len(ids)
            a = array("I", ids)
            if swap:
                a.byteswap()
            return a.tobytes()

        join = sum if counts else b"".join
        token = Memo(lambda p: pack([k.id for k in tokenize(p.encode().decode("latin-1").translate(table))]))

        def value(chunk: str):
            """One word, with or without the space before it."""
            if max(chunk, default="") >= "\u0250":  # beyond Latin, classes depend on the Unicode version
                return pack(tok.encode(chunk, add_special_tokens=False).ids)
            body = chunk[1:] if chunk[:1] == " " else chunk
            if body.isalpha():  # kept by the caller's memo alone; letters of ASCII stand for themselves
                return pack([k.id for k in tokenize(chunk.replace(" ", space))]) if chunk.isascii() else token.value(chunk)
            if body[:-1].isalpha() and body[-1] in ".,":
                return join((token[chunk[:-1]], token[body[-1]]))
            return join([token[p] for p in pieces(chunk)])

        self.pack, self.first, self.rest = pack, Memo(value), Memo(lambda w: value(" " + w))
        self.line_break = value("\n") if self.by_word else None

    def whole(self, text: str) -> bool:
        """Whether the text has to go to the library whole."""
        return (not self.by_word or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text.endswith(" ")
                or text.startswith(" ") or bool(self.other_space(text)) or any(s in text for s in self.special))

    def encode(self, text: str):
        """Count of ids, or the ids as little-endian unsigned 32-bit bytes."""
        if self.whole(text):
            return self.pack(self.tok.encode(text, add_special_tokens=False).ids)
        if not text:
            return self.pack([])
        first, rest, out = self.first, self.rest.__getitem__, []
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if i:
                out.append(self.line_break)
            out.append(first[words[0]])
            out.extend(map(rest, words[1:]))
        return sum(out) if self.counts else b"".join(out)


def encoder(path: str, counts: bool) -> Encoder:
    """The worker's encoder (kept between tasks, like Spark's workers)."""
    memo = worker_state()
    if (path, counts) not in memo:
        memo[(path, counts)] = Encoder(path, counts)
    return memo[(path, counts)]
