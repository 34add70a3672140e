"""Access to public tokenizer files."""

from __future__ import annotations

import base64
import json
import re

# Unicode white space, as \s in the splitting pattern of the rank files has it.
SPACES = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def byte_letters() -> list[str]:
    """The letter that byte-level BPE files write for each byte: printable bytes themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b) if b in plain else chr(extra))
        extra += b not in plain
    return letters


class JsonEncoder:
    """Ids of a byte-level BPE ``tokenizers`` file, without special tokens around the text.

    Texts with one of the file's special strings, or with characters beyond Latin
    letters, go through ``tokenizers`` itself; the others through the same
    vocabulary as ranks, several times faster and with the same ids (the tests
    compare the two).
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path, self.whole = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [a["content"] for a in spec.get("added_tokens", [])]
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        vocab = {bytes(to_byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in self.special}
        self.plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or not text.isascii() and _BEYOND_LATIN.search(text):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.plain.encode_ordinary(text)


_ENCODERS: dict[str, JsonEncoder] = {}


def json_encoder(path: str) -> JsonEncoder:
    """The encoder of a file, one per process."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = JsonEncoder(path)
    return _ENCODERS[path]
