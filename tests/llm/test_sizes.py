"""Documents that share their keys with a smaller one that none of them links with."""

import random

import plain

from sheaf.llm import nearjoin


def test_members_link_past_a_centre_of_another_size(docs, monkeypatch):
    """An excerpt is the centre of all keys: longer versions of it still find each other."""
    rng = random.Random(1)
    vocab = plain.vocabulary(rng)
    base = [rng.choice(vocab) for _ in range(300)]
    texts = [" ".join(base[:n]) for n in (100, 140, 146, 200, 206, 290, 300)]

    def around_the_smallest(classes):
        rows = sorted(classes.select("n_shingles", "id").collect())
        pairs = [(rows[0].id, rows[0].n_shingles, r.id, r.n_shingles) for r in rows[1:]]
        return classes.sparkSession.createDataFrame(pairs, "a bigint, a_tag bigint, b bigint, b_tag bigint")

    monkeypatch.setattr(nearjoin, "_centres", around_the_smallest)
    rows = list(enumerate(texts))
    found = {r.doc_id: r.component_id for r in nearjoin.near_duplicates(docs(rows), 85).collect()}
    assert found == plain.near(rows, 85) and len(set(found.values())) == 4
