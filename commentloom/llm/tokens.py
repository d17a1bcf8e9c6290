"""Token ids of whole texts, by the vocabulary files of public tokenizers."""

from __future__ import annotations

import base64
import functools
import re
import sys
from array import array

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
CACHE_CHUNKS = 250_000
# White space ahead of a space, or what one library may take for white space and another not.
_UNSURE = re.compile("[\\s\\x1c-\\x1f\\x85] ")
_CHUNK = re.compile("[\\s\\x1c-\\x1f\\x85]*[^\\s\\x1c-\\x1f\\x85]+|[\\s\\x1c-\\x1f\\x85]+$")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkTokenizer:
    """Byte-level BPE that remembers the ids of chunks.

    The tokenizer's pattern never joins a character to a space after it, so a text can be cut
    ahead of each run of white space and the ids of the chunks, put together, are those of the
    text. Words repeat, so most chunks are found in the cache; the cache is emptied when full.

    ``path`` names the vocabulary for the ``tokenizers`` library. The file beside it has the same
    vocabulary as ranks for ``tiktoken``, which gives the same ids for one chunk ten times faster.
    Chunks with a special token are left to ``tokenizers``.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding(
            "chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={}
        )
        self.cache: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if _UNSURE.search(text):
            return _CHUNK.findall(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + word for word in rest]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return b"".join(self.encode_chunks(self.chunks(text)))

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cache = self.cache
        try:
            return [cache[c] for c in chunks]
        except KeyError:
            pass
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        found = []
        for chunk in chunks:
            ids = cache.get(chunk)
            if ids is None:
                ids = cache[chunk] = self._ids(chunk)
            found.append(ids)
        return found

    def _ids(self, chunk: str) -> bytes:
        if any(s in chunk for s in self.special):
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(chunk)
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkTokenizer:
    """One per Python worker and file."""
    return ChunkTokenizer(path)
