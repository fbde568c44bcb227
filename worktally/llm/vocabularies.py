"""Places of the public tokenizers' vocabulary files, which stay outside the repository."""

from __future__ import annotations

import os

#: The folder of the vocabulary files unless a path is given.
FOLDER = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """The path of a vocabulary file."""
    return os.path.join(folder or FOLDER, name)
