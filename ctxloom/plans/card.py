"""Dataset card completion."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ctxloom.sources.listing import dataset_size
from ctxloom.sources.manifest import MANIFEST_NAME, manifest_tokens, read_manifest
from ctxloom.sources.paths import read_small, write_small


def finalize_card(
    spark: SparkSession, card_in: str | None, card_out: str | None, folder: str, seqlen: int, tokenizer: str
) -> tuple[dict | None, list[str]]:
    """(card, warnings). Without both paths there is no card.

    URLs and ``tokenized`` are always set; ``tokenizer``, ``num_tokens`` and ``size`` only where the
    key is absent. The counts are Spark aggregates; the card itself is one small object.
    """
    if card_in is None or card_out is None:
        return None, []
    card = json.loads(read_small(card_in))
    if card is None:
        card = {}
    if not isinstance(card, dict):
        raise ValueError(f"card is not a JSON object: {card_in}")
    warnings = []
    base = folder.rstrip("/")
    card["dataset_url"] = base + "/"
    card["manifest_url"] = f"{base}/{MANIFEST_NAME}"
    card["tokenized"] = True
    if "tokenizer" not in card:
        warnings.append(f"tokenizer inferred to be {tokenizer}")
        card["tokenizer"] = tokenizer
    counted = manifest_tokens(read_manifest(spark, base), seqlen).first()[0]
    if "num_tokens" not in card:
        card["num_tokens"] = counted
    elif type(card["num_tokens"]) is not int or card["num_tokens"] != counted:
        warnings.append(f"num_tokens is given as {card['num_tokens']} but was counted as {counted}")
    if "size" not in card:
        card["size"] = dataset_size(spark, base).first()[0]
    text = json.dumps(card, indent=2, sort_keys=True, ensure_ascii=False)
    write_small(card_out, text.encode())
    return card, warnings
