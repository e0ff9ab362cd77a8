"""Token ids of whole texts by a public byte-level BPE file, as little-endian unsigned 32-bit values.

Byte-level BPE first cuts a text into pre-tokens, and a pre-token always starts at a single space or newline between two
non-blank characters. Ids of such pieces are therefore looked up by word. Unseen words are encoded with the merge ranks read from
the same file, which is several times faster for single words; texts with other white space or a special token's name go
to the tokenizer whole.
"""

from __future__ import annotations

import functools
import json
import os
from array import array

MAX_WORDS = 300_000  # remembered words of a worker, twice; a speed setting without effect on results
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker for each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def merge_ranks(path: str):
    """The file's merges as ranks of byte strings; None when its ids aren't in the order of the merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, special = file["model"]["vocab"], {t["content"] for t in file.get("added_tokens", [])}
    # Byte-level files write printable Latin-1 bytes as themselves and the others as code points from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in file["model"]["merges"]]
    ids = [vocab.get(m, -1) for m in merges]
    if ids != sorted(set(ids)) or (file.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or file.get("normalizer"):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """encode(texts) gives the ids of each text as bytes, four for each id."""

    def __init__(self, path: str | None = None):
        path = path or default_path()
        self.tokenizer, self.ranks = tokenizer(path), merge_ranks(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        return array("I", self.ranks.encode_ordinary(word)).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > MAX_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = []
        for t in texts:
            plain = self.ranks and t and t.replace("\n", " ") == " ".join(t.split()) and "\0" not in t
            if not plain or any(s in t for s in self.special):
                out.append(self._whole(t) if t else b"")
                continue
            # A word carries the space or newline before it; the first one carries nothing.
            words = t.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
            for w in set(words):
                if w not in known:
                    known[w] = older.get(w) or self._word(w)
            out.append(b"".join(map(known.__getitem__, words)))
        return out


@functools.cache
def encoder(path: str | None = None) -> Encoder:
    """One for each worker process, so that words stay known from task to task."""
    return Encoder(path)
