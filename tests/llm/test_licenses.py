import re

import pytest

from subledger.llm.licenses import BASE_PHRASES, evaluate, label_of, postfix, scan, scan_licenses


def base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    hits = [(i, label) for p, label in BASE_PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


TEXTS = [
    None, "", "Released under the MIT License.", "under the mit license under the mit license", "Apache License, Version 2.0; CC BY-NC 4.0 cc by nc cc by nc",
    "mitunder the mit licensed", "é under the MIT license é", "Cc-By\x00Nc", "cc by ncé", "UNDER_THE_MIT_LICENSE " * 2000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_places_equal_brute_force(text):
    assert scan(None if text is None else text.encode())[:5] == base(text)


def test_expressions():
    assert postfix("MIT OR Apache-2.0 AND BSD-3-Clause")[0] == ["MIT", "Apache-2.0", "BSD-3-Clause", "and", "or"]
    assert postfix("(MIT or Apache-2.0) and GPL-2.0-only with Classpath-exception-2.0 */") == (["MIT", "Apache-2.0", "or", "GPL-2.0-only", "Classpath-exception-2.0", "with", "and"], True)
    assert evaluate("GPL-3.0-or-later OR MIT") == (["gpl-3", "mit"], 1.0)
    assert evaluate("GPL-3.0 AND MIT") == (["gpl-3", "mit"], 0.3)
    assert evaluate("GPL-2.0 WITH Classpath-exception-2.0") == (["gpl-2"], 0.65)
    for broken in ("", "MIT AND", "(MIT OR Apache-2.0", "AND MIT"):
        assert evaluate(broken)[1] is None
    assert [label_of(x) for x in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-2.0+", "MIT")] == ["apache-2", "cc-by-nc", "gpl-2", "mit"]


def test_tags_and_notices_add_labels():
    row = scan(b"# SPDX-License-Identifier: (MIT OR GPL-2.0-only)\n# All rights reserved. Gnu General Public License, version 3")
    assert row[4] == "" and row[5] == "gpl-2,gpl-3,mit,proprietary" and 0.9 < row[6] <= 1 and row[7:9] == (1, 0)
    assert scan(b"Plain prose about nothing.")[5:7] == ("", 0.0)


def test_edges(edge_docs, no_docs, edge_rows):
    rows = scan_licenses(edge_docs).collect()
    assert len(rows) == len(edge_rows) and scan_licenses(no_docs).count() == 0
    by = {(r["doc_id"], r["n_words"]) for r in rows}
    assert by == {(r[0], base(r[1])[0]) for r in edge_rows}


def test_many_notices_and_tags_take_linear_time():
    import time

    unit = b"Gnu General Public License, version 3 under the MIT license. SPDX-License-Identifier: MIT OR Apache-2.0 mit license "
    spent = []
    for n in (2000, 16000):
        began = time.process_time()
        row = scan(unit * n)
        spent.append(time.process_time() - began)
        assert row[1] == n and row[7] == n and row[5] == "apache-2,gpl-3,mit"
    assert spent[1] < 24 * max(spent[0], 0.02) and spent[1] < 20


def test_covered_notices_equal_brute_force():
    from subledger.llm.licenses import _inside

    import random
    rng = random.Random(4)
    for _ in range(300):
        spans = sorted({(a, a + rng.randint(1, 9)) for a in (rng.randint(0, 20) for _ in range(rng.randint(0, 12)))})
        hits = [(a, b, rng.choice([None, "x", "y"]), 0.5, False) for a, b in spans]
        want = {(a, b) for a, b, *_ in hits if any(s <= a and b <= e and (s, e) != (a, b) for s, e, label, *_ in hits if label)}
        assert _inside(hits) == want


def test_expression_ends_with_its_line():
    assert scan(b"SPDX-License-Identifier: MIT\nOR GPL-3.0")[5] == "mit"
    assert scan(b"x SPDX-License-Identifier: MIT SPDX-License-Identifier: ISC\nSPDX-License-Identifier:\n")[7:9] == (3, 1)
