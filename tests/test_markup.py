import random

from quire.sources import markup
from tests.conftest import frame


def test_tokens_get_the_boxes_of_the_strings_they_stand_in(spark):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzáčéř"
    words = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(300)]
    tokens = [("d", i, w.upper() if i % 7 == 0 else w) for i, w in enumerate(words)]
    strings, at = [], 0
    while at < len(words):  # a string holds one or two tokens; every ninth has a misread letter
        n = rng.choice([1, 1, 2])
        text = " ".join(words[at : at + n])
        if len(strings) % 9 == 4:
            text = text[:1] + "#" + text[2:]
        strings.append(("d", len(strings), text, 1 + at // 100, float(at), 0.0, float(at + n), 1.0))
        at += n
    owner = {}
    for _, seq, _, page, x0, _, x1, _ in strings:
        for i in range(int(x0), int(x1)):
            owner[i] = (page, x0, x1)
    tokens.append(("e", 0, "alone"))
    got = markup.align_tokens(frame(spark, tokens, "doc string, tok bigint, form string"), frame(spark, strings, "doc string, seq bigint, content string, page_num int, x0 double, y0 double, x1 double, y1 double")).collect()
    found = {(r["doc"], r["tok"]): (r["page_num"], r["x0"], r["x1"]) for r in got}
    assert len(got) == len(tokens) and found["e", 0] == (None, None, None)
    right = sum(found["d", i] == owner[i] for i in range(len(words)))
    assert right >= 0.97 * len(words)
    empty = frame(spark, [], "doc string, tok bigint, form string")
    assert markup.align_tokens(empty, frame(spark, strings, "doc string, seq bigint, content string, page_num int, x0 double, y0 double, x1 double, y1 double")).collect() == []
