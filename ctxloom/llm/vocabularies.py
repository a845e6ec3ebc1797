"""Where the public vocabulary files are read: on the driver, by name, from a folder that is a parameter."""

from __future__ import annotations

import base64
import os

FOLDER: str | None = None


def vocabulary_path(name: str, folder: str | None = FOLDER) -> str:
    """The file in ``folder``, or where the installed collection of public vocabularies has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_text(name: str, folder: str | None = FOLDER) -> str:
    with open(vocabulary_path(name, folder), encoding="utf-8") as file:
        return file.read()


def read_ranks(name: str, folder: str | None = FOLDER) -> dict[bytes, int]:
    """Token bytes to rank of a rank file."""
    pairs = (line.split() for line in vocabulary_text(name, folder).splitlines())
    return {base64.b64decode(pair[0]): int(pair[1]) for pair in pairs if pair}


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN
