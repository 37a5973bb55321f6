"""Tables with every awkward case, for all operators."""

CLASHING = ["tag", "fp", "fingerprint", "component_id", "key", "kind", "n_lines", "n_removed", "gone_lines", "words", "lines", "spans", "base", "stratum", "kept", "shard", "slot", "size", "ids", "mark_key", "sym", "starts", "block"]

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(20_000))

AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi"),
    (2, None),
    (3, ""),
    (4, " \n\t\x0b\x0c\r "),
    (5, LONG),
    (6, LONG),
    (7, "one"),
    (7, "one"),
    (8, "a\nb\nc\nd\na\nb\nc\nd"),
    (9, "a\nb\nc\nx\n"),
    (None, "a\nb\nc\nx\n"),
    (None, None),
    (10, "çé ▁ 日本語 \U0001f600  two  spaces\n\n\ntail " * 3),
    (-5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi"),
]


def docs(spark, rows=AWKWARD, clash=True):
    """Documents with ``rows`` (id, text), and columns whose names operators use inside."""
    names = CLASHING if clash else []
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in names)
    made = [(i, t, None if k % 3 == 0 else "en", None, None if t is None else len(t), *["?"] * len(names)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, schema)


def key(row):
    return tuple((v is not None, v) for v in row)
