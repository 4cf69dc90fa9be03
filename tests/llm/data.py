"""Small tables with the cases that every operator has to stand."""

import random

LONG = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt " * 300

DOCS = "doc_id long, text string, N_WORDS string, sequence_id int, __ledger int"


def documents(spark, seed=1):
    """Null and empty texts, null and repeated ids, repeated rows, very long texts, clashing columns."""
    rnd = random.Random(seed)
    stock = ["alpha", "Beta", "gamma", "été", "straße", "<|endoftext|>", "it's", "42", "x", "日本", "!!", "###"]
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "two words"), (6, LONG), (6, LONG), (7, LONG + "tail"),
        (None, "a text without an id"), (None, "a text without an id"), (8, "\n\n"), (9, "word " * 40),
    ]
    line = "This line is found in many documents, Again and again"
    for k in range(10, 40):
        words = " ".join(rnd.choice(stock) for _ in range(rnd.randrange(5, 60)))
        rows.append((k, f"{words}\n  {line}\t\n{words[:30]}" if k % 3 else words))
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    for k in range(40, 60):
        copy = list(base)
        for _ in range(rnd.randrange(0, 5)):
            copy[rnd.randrange(len(copy))] = f"v{k}"
        rows.append((k, " ".join(copy)))
    return spark.createDataFrame([(i, t, "clash", 3, None) for i, t in rows], DOCS)


def empty(df):
    return df.where("false")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
