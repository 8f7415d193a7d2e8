import os
import random

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")


def docs_frame(spark, rows, extra=False):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:  # columns whose names clash with those that operators use inside
        for c in ("fp", "u", "v", "t", "key", "pos", "size", "score", "count", "node", "root", "component_id_", "k0"):
            df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def vocabulary(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(2, 9))) for _ in range(n)]
