"""Token ids of whole texts, by a public byte-level vocabulary.

``tokenizers`` defines the ids. Texts in Latin letters are encoded by ``tiktoken`` with the same
merges, which gives the same ids several times faster; all others go through ``tokenizers``. So do
texts with a long run of white space, on which the fast coder's look-ahead runs out of stack, and
any other text that it gives up on.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Sequence

import numpy as np

from wardflow.llm.common import once

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

# Texts of these characters only take the fast way: there both libraries split alike.
_LATIN = re.compile("[\t\n\r -~\xa1-ɏ‐-‧€]*")
_RUN = re.compile(r"\s\s")
_LONG_RUN = re.compile(r"\s{4096}")
# Fixed value: the vocabulary's marker between texts.
MARKER = "<|endoftext|>"


def _library(marker: bool):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    coder.encode_special_tokens = not marker
    return lambda text: np.array(coder.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _load(marker: bool) -> Callable[[Sequence[str]], list[np.ndarray]]:
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    # Without a run of white space the look-ahead of the pattern never matters, and without it splitting is faster.
    pattern = public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", "")
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def fast(text: str) -> np.ndarray | None:
        if not _LATIN.fullmatch(text) or (marker and MARKER in text) or _LONG_RUN.search(text):
            return None
        coder = whole if _RUN.search(text) else plain
        try:
            return np.array(coder.encode_ordinary(text), dtype="<u4")
        except (KeyboardInterrupt, SystemExit, GeneratorExit):
            raise
        except BaseException:  # a panic of the coder is no Exception
            return None

    def encode(texts: Sequence[str]) -> list[np.ndarray]:
        out = [fast(text) for text in texts]
        for i, ids in enumerate(out):
            if ids is None:  # the library itself, loaded only where it is needed
                out[i] = once(f"library-{marker}", lambda: _library(marker))(texts[i])
        return out

    return encode


def encoder(marker: bool = False) -> Callable[[Sequence[str]], list[np.ndarray]]:
    """A function from texts to arrays of ids; loaded once per Python worker.

    With ``marker`` the vocabulary's marker in a text becomes its one id, as the library does
    unless told otherwise; without, it is text like any other.
    """
    return once(f"encoder-{marker}", lambda: _load(marker))
