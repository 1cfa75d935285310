"""The corpus pipeline against a brute-force version."""

import os
import re
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
import public_tokenizers
from tokenizers import Tokenizer

from .conftest import SCHEMA
from .test_native_ops import brute_lines
from .test_python_ops import brute_base, brute_classes, brute_verdicts, check_pieces

from martkit.llm import line_dedup, packing, secret_scan


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard", "secret_scan", "packing"]


def test_stages_equal_brute_force(spark, edge, edge_df, tmp_path):
    docs, seen = edge_df, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, None)
        if name != "packing":
            assert out.columns == edge_df.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        seen.append([tuple(r) for r in docs.collect()] if name != "packing" else docs.collect())

    kept = [r for r, ok in zip(edge, brute_verdicts([(r[1], r[2]) for r in edge])) if ok]
    assert kept and not any(brute_base(r[1])[-1] for r in kept)
    assert Counter(seen[0]) == Counter(kept)

    shared = "the same line of words on many sites"
    texts = Counter((i, None if k is None else tuple(k)) for i, _, k, _ in brute_lines(kept, line_dedup.MIN_SITES, line_dedup.MIN_CHARS))
    assert Counter((r[0], tuple(x for x in r[1].split("\n") if x.strip() != shared) if r[1] else ()) for r in seen[1]) == texts
    assert sum(x.strip() == shared for r in seen[1] for x in r[1].split("\n")) == (1 if any(shared in r[1] for r in kept) else 0)
    assert all(r[4] == len(r[1]) and r[6] == "n" and r[9] == "c" for r in seen[1])

    docs = sorted(seen[1], key=lambda r: (r[0] is None, r[0] or 0))
    root, _ = brute_classes([r[1] for r in docs])
    assert len(seen[2]) == len(set(root)) and not Counter(seen[2]) - Counter(seen[1])

    clean = [(r[0], secret_scan.redact(r[1], secret_scan.spans(r[1]))) for r in seen[2]]
    assert Counter((r[0], r[1]) for r in seen[3]) == Counter(clean)
    assert any("[SECRET:" in t for _, t in clean)

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check_pieces(seen[4], Counter((i, (*tok.encode(t, add_special_tokens=False).ids, 1)) for i, t in clean), packing.LENGTH)


def test_empty_table(spark, empty_df):
    docs = empty_df
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
    assert docs.collect() == []


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    total = out.agg({"length": "sum", "sequence_id": "max"}).first()
    assert total[0] > 0 and (total[1] + 1) * packing.LENGTH - total[0] < packing.LENGTH


def test_entry_without_the_subpackage(tmp_path):
    """The other queries import when the subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "martkit"), tmp_path / "martkit", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
