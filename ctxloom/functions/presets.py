"""Special-token presets per tokenizer and backend."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the output format: vocabulary sizes, special ids and split patterns.
NEOX = "EleutherAI/gpt-neox-20b"
LLAMA3 = "meta-llama/Meta-Llama-3-8B"
VOCAB_SIZE = {NEOX: 50254, LLAMA3: 128256}
EOT = 0
PAD_OFFSET = 2
LLAMA3_BOS = 128000
PATTERNS = {
    "neox": r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
    "llama3": (
        r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
        r"| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    ),
}

BACKENDS = ("hf", "ranks")


@dataclass(frozen=True)
class Preset:
    tokenizer: str
    backend: str
    vocab: int
    eot: int
    pad: int
    bos: int | None
    pattern: str


def preset(tokenizer: str = NEOX, backend: str = "hf") -> Preset:
    """Look up a preset. Only Llama-3 on the rank backend puts a BOS before each document."""
    if tokenizer not in VOCAB_SIZE:
        raise ValueError(f"unknown tokenizer name: {tokenizer}")
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend: {backend}")
    vocab = VOCAB_SIZE[tokenizer]
    llama = tokenizer == LLAMA3
    return Preset(
        tokenizer=tokenizer,
        backend=backend,
        vocab=vocab,
        eot=EOT,
        pad=vocab + PAD_OFFSET,
        bos=LLAMA3_BOS if llama and backend == "ranks" else None,
        pattern="llama3" if llama else "neox",
    )


def all_presets() -> list[Preset]:
    return [preset(name, backend) for name in VOCAB_SIZE for backend in BACKENDS]
