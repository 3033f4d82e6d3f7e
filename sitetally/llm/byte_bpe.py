"""Token ids of a byte-level BPE vocabulary file."""

from __future__ import annotations

import json
import os

import numpy as np

from .common import resident

#: How such vocabularies split text before the merges; fixed by the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below this character the libraries' Unicode tables cannot differ.
PLAIN = "ɐ"


class ByteBpe:
    """``encode(text)``: the ids that ``tokenizers`` gives for the whole text, as an array.

    Texts of Latin characters go to ``tiktoken``, set up from the same file, which takes a quarter of the time; all others
    go to ``tokenizers`` itself. Tests hold both against each other.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self.tokenizer = path, None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = _bytes_of_characters()
        order = [c for c in model["vocab"] if len(c) == 1 and c in byte_of]
        order += ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        ids = [model["vocab"][token] for token in order]
        # the engine merges by id: usable if the file numbers its merges in their order
        self.fast = None
        if ids == sorted(ids):
            ranks = {bytes(byte_of[c] for c in token): k for token, k in zip(order, ids, strict=True)}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if self.fast is not None and max(text) < PLAIN:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)
        if self.tokenizer is None:  # only for texts that need it, as it takes much memory
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = True
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def _bytes_of_characters() -> dict[str, int]:
    """The format writes printable bytes as themselves, the others as characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def encoder(path: str) -> ByteBpe:
    """One for all tasks of a worker."""
    return resident(f"bpe {path}", lambda: ByteBpe(path))
