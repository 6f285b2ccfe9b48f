"""Rows and comparisons shared by the pipeline operators' tests."""

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

PASSAGE = " ".join(f"shared{i} passage{i % 7}" for i in range(40))


def awkward_rows(seed: int = 5) -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, near copies, a hot text and odd characters."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "Straße", "x|y", "a&b", "ONE", "two,"]

    def prose(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    rows = [(1, "", "en", "s0", 0), (2, None, "en", "s0", None), (3, "   \n\t ", None, None, 3),
            (4, "one two three", "en", "s1", 13), (5, "ONE two THREE", "en", "s1", 13), (None, prose(30), "fr", "s1", 1),
            (6, "x" * 40_000, "de", "s2", 40_000), (7, prose(9_000), "de", "s2", None),
            (8, "a\n" * 300 + "b", "es", "s2", 601), (9, "  é́ \U0001f600 z\x0b\x0cq", "fr", None, 9)]
    hot = prose(60)
    rows += [(100 + i, hot, "en", "hot", len(hot)) for i in range(40)]
    base = prose(80).split(" ")
    for i in range(30):
        near = list(base)
        near[r.randrange(80)] = f"edit{i}"
        rows.append((200 + i, " ".join(near), "en", "hot", 1))
    rows += [(300 + i, prose(r.randrange(1, 16)), r.choice(["en", "de", None]), r.choice(["s0", "s1"]), i)
             for i in range(60)]
    rows += [(400 + i, f"{prose(12)} {PASSAGE} {prose(r.randrange(40))}", "en", "s0", i) for i in range(12)]
    rows += [rows[20], rows[20], rows[45], rows[3]]
    return rows



def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def by_id(rows):
    """Rows sorted with null ids first."""
    return sorted(rows, key=lambda x: tuple((v is not None, v) for v in x))
