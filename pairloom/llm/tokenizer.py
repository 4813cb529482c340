"""Public tokenizers, loaded once in each Python worker from the folder that a parameter names."""

from __future__ import annotations

import base64
import os
import re

TOKENIZER_DIR = "/opt/tokenizers"
# Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A pre-token of PATTERN never holds a blank after another character, so a text may be cut before any white space that
#: follows something else: each such segment has the same ids alone as in its text.
SEGMENT = re.compile(r"\s*\S+|\s+")
#: Python counts these as white space and the pattern doesn't; texts that hold one are encoded whole.
SEPARATORS = re.compile("[\x1c-\x1f]")
CACHED_CHARS, CACHED_SEGMENTS = 32, 200_000

_loaded: dict[tuple[str, str], object] = {}


class ByteBpe:
    """Byte-level BPE with a bounded cache of short segments."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.inner = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        if SEPARATORS.search(text):
            return self.inner.encode_ordinary(text)
        ids: list[int] = []
        cache, whole = self.cache, self.inner.encode_ordinary
        if len(cache) > CACHED_SEGMENTS:
            cache.clear()
        for segment in SEGMENT.findall(text):
            got = cache.get(segment)
            if got is None:
                got = whole(segment)
                if len(segment) <= CACHED_CHARS:
                    cache[segment] = got
            ids += got
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.inner.decode_bytes(ids).decode("utf-8", errors="replace")


class JsonTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.inner.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        return self.inner.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.inner.decode(ids, skip_special_tokens=False)


class PieceTokenizer:
    def __init__(self, path: str):
        import sentencepiece

        self.inner = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, text: str) -> list[int]:
        return self.inner.encode(text, num_threads=1)

    def decode(self, ids: list[int]) -> str:
        return self.inner.decode(ids)


KINDS = {".tiktoken": ByteBpe, ".json": JsonTokenizer, ".model": PieceTokenizer}


def load(name: str, folder: str = TOKENIZER_DIR):
    """The tokenizer of that name; of several files, the first kind of KINDS."""
    key = (folder, name)
    if key not in _loaded:
        for suffix, kind in KINDS.items():
            path = os.path.join(folder, name + suffix)
            if os.path.exists(path):
                _loaded[key] = kind(path)
                break
        else:
            raise ValueError(f"no tokenizer {name!r} in {folder}")
    return _loaded[key]


def is_byte_level(name: str, folder: str = TOKENIZER_DIR) -> bool:
    return os.path.exists(os.path.join(folder, name + ".tiktoken"))
