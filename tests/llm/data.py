"""A small table with every odd case: nulls, empties, ties, repeats, long texts, clashing columns."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _id bigint, _text string, _size int, "
    "_label string, _row string, score double, n_words string, path string"
)


def texts(seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, line = say(70), say(12).capitalize() + "."
    out = [None, "", " \t\n ", "one", "Two words", "É ß İ  x y", "a\n\na\n a \n", passage, passage, passage.upper()]
    for i in range(60):
        body = say(r.choice([30, 60, 120, 300]))
        if i % 4 == 0:
            body = body[: len(body) // 2] + " " + passage + " " + body[len(body) // 2 :]
        if i % 3 == 0:
            body = f"  {line.upper() if i % 2 else line}\t\n{body}\n{line}"
        out.append(body)
    out += [out[20], out[20], out[21] + " end", out[22].replace("a", "b", 1), say(6000), say(49), say(50), "spam ham " * 400, "x" * 5000]
    return out


def rows(seed=1):
    body = texts(seed)
    out = []
    for i, t in enumerate(body):
        source = None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}" if i % 2 else ""
        out.append([i * 3 % 97 + 200 * (i // 97) if i != 30 else -5, t, "en", source, len(t or "")])
    out.append([None, body[25], None, None, None])
    out.append([None, body[40], None, None, None])
    out.append(list(out[15]))  # a repeated row
    out.append([out[16][0], "another text under a used id " + body[17], "en", "s1", 1])
    return [tuple(x) for x in out]


def documents(spark, seed=1):
    extra = (7, "clash", 1, "l", "r", 0.5, "w", "p")
    return spark.createDataFrame([x + extra for x in rows(seed)], SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(seed=1):
    return [(x[0], x[1]) for x in rows(seed)]


def as_set(found):
    """Rows as a sorted list, nulls allowed."""
    return sorted((tuple(r) for r in found), key=repr)
