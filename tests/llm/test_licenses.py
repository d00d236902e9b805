from __future__ import annotations

from burnlens.llm import licenses as L


def test_exact_near_and_absent(make_docs, odd, no_docs):
    mit = L.TEMPLATES["MIT"][2]
    docs = make_docs([
        (1, "Some text. Released under the MIT License.\nMore"), (2, "x " * 500 + mit.upper() + " y" * 500),
        (3, mit.replace("obtaining", "getting")), (4, "the licence of a dog, released"), (5, None),
        (6, "Licensed under CC BY-NC 4.0."), (7, "This work is licensed under the GNU General Public License, version 3."),
        (7, "This work is licensed under the GNU General Public License, version 3.")])
    got = {(r.doc_id, r.license): r for r in L.scan(docs).collect()}
    assert set(got) == {(1, "MIT"), (2, "MIT"), (3, "MIT"), (6, "CC-BY-NC-4.0"), (7, "GPL-3.0")}
    assert got[1, "MIT"].dice == 1.0 and got[1, "MIT"].start_word == 2 and 0.8 <= got[3, "MIT"].dice < 1
    assert got[2, "MIT"].start_word == 500
    assert L.scan(odd).count() == 0 and L.scan(no_docs).count() == 0


def test_size_bound():
    assert [L.needed(n) for n in (1, 4, 5, 10, 20)] == [1, 4, 4, 8, 16]
