"""Token ids of whole texts with a tokenizer file of the ``tokenizers`` library.

A rank file with the same vocabulary may be given beside it: plain texts then take the faster
encoder, whose ids are the same there. "Plain" means that no character lies above U+052F and no
special token is spelled out, so that both libraries split alike (tests try every such character);
all other texts go through ``tokenizers``. Files are opened once per Python worker.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import public_tokenizers

JSON = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
_ODD = re.compile("[^\x00-ԯ]")


def default_files() -> tuple[str, str | None]:
    return public_tokenizers.path(JSON), public_tokenizers.path(RANKS)


class Encoder:
    def __init__(self, json_file: str, rank_file: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives one core to a task
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_file)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if rank_file:
            import tiktoken

            with open(rank_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        return _ODD.search(text) is None and not any(s in text for s in self.special)

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and self.plain(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=4)
def encoder(json_file: str, rank_file: str | None = None) -> Encoder:
    return Encoder(json_file, rank_file)
