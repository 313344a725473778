"""Token ids of a byte-level BPE vocabulary inside tasks.

The ids are those of the ``tokenizers`` library for the given .json file. Where the same vocabulary is also
there as ranks (.tiktoken), ``tiktoken`` encodes, which gives the same ids several times as fast; texts that its
pattern engine refuses (very long runs of white space) go to ``tokenizers``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Callable
from functools import lru_cache

# The pre-tokenizer's pattern of byte-level vocabularies with this kind of file; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def public_path(name: str) -> str:
    """Where the box keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def version(path: str) -> str:
    """Digest of the tokenizer's file: another vocabulary never meets this one's counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def ranked(path: str, ranks_path: str):
    """A ``tiktoken`` encoding of the vocabulary; None where there are no ranks, or where the .json file splits or changes
    texts in another way than the pattern here."""
    if not os.path.exists(ranks_path):
        return None
    import tiktoken

    with open(path) as file:
        stated = json.load(file)
    if stated["normalizer"] is not None or not _splits_as_assumed(stated["pre_tokenizer"]):
        return None
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    special = {t["content"]: t["id"] for t in stated["added_tokens"]}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _splits_as_assumed(stated: dict | None) -> bool:
    """Whether a file's pre-tokenizer is the byte-level one, with its own pattern and no added space."""
    return bool(stated) and stated["type"] == "ByteLevel" and not stated["add_prefix_space"] and stated.get("use_regex", True)


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None = None) -> Callable[[str], list[int]]:
    """Text -> ids, without begin or end tokens; special strings in a text count as the special token.

    One instance per Python worker. ``ranks_path``: the same vocabulary as ranks; beside it ``tokenizers`` is loaded only for a
    text that needs it.
    """

    @lru_cache(maxsize=1)
    def plain():
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        return found

    slow = lambda text: plain().encode(text, add_special_tokens=False).ids
    fast = ranked(path, ranks_path) if ranks_path else None
    if fast is None:
        plain()
        return slow

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            return slow(text)

    return encode
