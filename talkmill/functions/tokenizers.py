"""Tokenizers in local files, by the kind of file; a folder is searched for one."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable

#: Names that a folder is searched for, in this order.
NAMES = ("tokenizer.json", "tokenizer.model", "vocab.tiktoken")


def load(path: str, pattern: str = r"\s*\S+|\s+") -> Callable[[list[str]], list[list[int]]]:
    """A function from texts to ids, special tokens as the file has them. pattern: what splits texts before the merges of a file of
    ranks, which does not say so itself."""
    if os.path.isdir(path):
        found = [p for n in NAMES if os.path.exists(p := os.path.join(path, n))]
        if not found:
            raise FileNotFoundError(f"no tokenizer in {path}")
        path = found[0]
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        return lambda texts: [x.ids for x in library.encode_batch(texts)]
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: pieces.encode(texts, num_threads=1)
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        merges = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [merges.encode_ordinary(t) for t in texts]
    raise ValueError(f"{path} is no tokenizer.json, .model or .tiktoken file")
