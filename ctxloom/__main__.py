"""``spark-submit`` / ``python -m ctxloom``: the two jobs from the command line."""

from __future__ import annotations

import argparse
import json

from ctxloom.functions.presets import NEOX, preset
from ctxloom.operators.encode import load_hf_vocab, load_rank_vocab
from ctxloom.plans.shuffle_only import shuffle_shards
from ctxloom.plans.tokenize_shuffle import tokenize_shuffle
from ctxloom.runtime import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ctxloom", description=__doc__)
    p.add_argument("--input", nargs="+", required=True, help="files or folders")
    p.add_argument("--output", required=True)
    p.add_argument("--tokenizer", default=NEOX)
    p.add_argument("--vocab", help="tokenizer.json, or a rank file with --use-tiktoken")
    p.add_argument("--use-tiktoken", action="store_true", help="encode with a rank file")
    p.add_argument("--seqlen", type=int, default=2049)
    p.add_argument("--wds-chunk-size", type=int, default=8192)
    p.add_argument("--seed", type=int, default=1234)
    p.add_argument("--num-local-cells", type=int, help="shuffle cell by cell with this many cells")
    p.add_argument("--shuffle-only", action="store_true", help="inputs are tars of ready contexts")
    p.add_argument("--ext", default=None)
    p.add_argument("--on-bad-record", choices=["fail", "drop"], default="fail")
    p.add_argument("--rows-per-block", type=int, help="spread the lines of few large compressed files over tasks, so many to each")
    p.add_argument("--input-json")
    p.add_argument("--output-json")
    p.add_argument("--work-dir")
    a = p.parse_args(argv)
    spark = build_session()
    common = dict(
        seqlen=a.seqlen, chunk_size=a.wds_chunk_size, seed=a.seed, ext=a.ext, tokenizer=a.tokenizer,
        shuffle="cells" if a.num_local_cells else "global", n_cells=a.num_local_cells or 128,
        input_json=a.input_json, output_json=a.output_json, work=a.work_dir,
    )
    if a.shuffle_only:
        result = shuffle_shards(spark, a.input, a.output, **common)
    else:
        rules = preset(a.tokenizer, "ranks" if a.use_tiktoken else "hf")
        if not a.vocab:
            p.error("--vocab is needed unless --shuffle-only is given")
        vocab = load_rank_vocab(spark, a.vocab, rules.pattern) if a.use_tiktoken else load_hf_vocab(spark, a.vocab)
        result = tokenize_shuffle(spark, a.input, a.output, vocab, on_bad_record=a.on_bad_record, rows_per_block=a.rows_per_block, **common)
    for warning in result.warnings:
        print("warning:", warning)
    print(json.dumps({**result.summary, "rejects": result.rejects}))


if __name__ == "__main__":
    main()
