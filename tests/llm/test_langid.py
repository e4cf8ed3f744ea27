import zlib

import numpy as np

from lakeweave.llm import langid
from lakeweave.llm.queries import op8_language_id, table


def test_held_out_accuracy_and_contract(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: (r.lang, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "lang", "text").collect()}
    got = op8_language_id(spark, sf_dir).collect()
    assert len(got) == len(langs) and {r.lang_pred for r in got} <= {x[0] for x in langs.values()} | {"und"}
    hits = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out and langs[r.doc_id][0]:
            hits.append(r.lang_pred == langs[r.doc_id][0])
    assert np.mean(hits) > 0.97


def test_clean_documents_are_accepted(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = langid.predict(docs, langid.train(docs)).collect()
    long = [r.accepted for r in out if r.text and len(r.text) > 200]
    assert np.mean(long) > 0.995


def small(documents):
    texts = {"en": "the house and the garden of the old man", "de": "das Haus und der Garten des alten Mannes", "fr": "la maison et le jardin du vieil homme"}
    return [(i, f"{texts[lang]} {i}", lang, "s", 1) for i, lang in enumerate(["en", "de", "fr"] * 40)]


def test_only_the_text_decides(documents, odd_rows):
    rows = small(documents)
    model = langid.train(documents(rows))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(documents(rows), model).collect()}
    blind = documents([(r[0], r[1], None, "other", None) for r in rows], extra=False)
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(blind, model).collect()} == plain
    assert all(plain[i][0] == rows[i][2] for i in plain)
    again = langid.train(documents(list(reversed(rows))))
    assert np.allclose(again.centroids, model.centroids) and again.languages == model.languages


def test_held_out_rows_teach_nothing(documents):
    rows = small(documents)
    held = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 4 == 2]
    more = rows + [(i, "zzz qqq xxx", "xx", "s", 1) for i in held]
    a, b = langid.train(documents(rows)), langid.train(documents(more))
    assert a.languages == b.languages and np.allclose(a.idf, b.idf) and np.allclose(a.centroids, b.centroids)


def test_odd_rows(documents, odd_rows):
    model = langid.train(documents(small(documents) + [(5000 + i, *r[1:]) for i, r in enumerate(odd_rows)]))
    docs = documents(odd_rows)
    out = langid.predict(docs, model)
    rows = out.collect()
    assert len(rows) == len(odd_rows) and set(docs.columns) <= set(out.columns)
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.score == 0 and not r.accepted))


def test_nothing_to_learn_from(documents):
    assert langid.train(documents([])) is None
    assert langid.train(documents([(1, None, "en"), (3, "!!", "en"), (4, "words", None)])) is None
    out = langid.predict(documents([(1, "words", "en")]), None).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert langid.predict(documents([]), None).count() == 0


def test_far_texts_are_rejected(spark, documents):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    known = docs.where("lang = 'en' and n_chars > 300").orderBy("doc_id").first().text[:150]
    out = langid.predict(documents([(1, "漢字仮名交じり文の例です" * 5, None), (2, known, None)]), langid.train(docs)).collect()
    assert {r.doc_id: r.accepted for r in out} == {1: False, 2: True}


def test_foreign_and_random_texts_in_latin_letters_are_rejected(spark, documents):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("lang is not null")
    model = langid.train(docs)
    rng = np.random.default_rng(6)
    far = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
        *["".join(rng.choice(list(letters), 600)) for letters in ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz     ")],
    ]
    out = langid.predict(documents([(i, t) for i, t in enumerate(far)]), model).collect()
    assert [r.accepted for r in out] == [False] * 4
    held = [r.text for r in docs.where(langid.held_out(docs.doc_id) & docs.text.rlike(r"\p{L}")).collect()]
    for upto in (40, 200, 1000, None):
        out = langid.predict(documents([(i, t[:upto]) for i, t in enumerate(held) if langid.LETTER.search(t[:upto])]), model).collect()
        assert np.mean([r.accepted for r in out]) > 0.98


def test_rows_without_a_letter_do_not_thin_the_sample(documents):
    """The few texts of a language are drawn, however many blank rows bear its label, and rows of one hash too."""
    rows = small(documents) + [(1000 + i, "  42 !!" if i % 2 else "", "es", "s", 1) for i in range(4000)]
    rows += [(9000 + i, "la casa y el jardín del hombre viejo", "es", "s", 1) for i in range(4)]
    rows += [(9996, "a casa e o jardim do homem velho", "pt", "s", 1)] * 3000
    model = langid.train(documents(rows), sample=5)
    assert set(model.languages) == {"en", "de", "fr", "es", "pt"}


def test_prediction_holds_few_vectors_at_once():
    """A vector has 8192 numbers; those of a whole slice of the batch, several times over, are most of a worker's memory."""
    import tracemalloc

    import pyarrow as pa

    model = langid.Model(np.ones(langid.BUCKETS), np.ones((2, langid.BUCKETS)), ["a", "b"], np.ones((2, langid.CLASSES)))
    batch = pa.RecordBatch.from_pydict({"text": [f"some words and the number {i}" for i in range(256)]})
    tracemalloc.start()
    try:
        assert sum(len(b) for b in langid._predict(model)(iter([batch]))) == 256
        assert tracemalloc.get_traced_memory()[1] < 24e6
    finally:
        tracemalloc.stop()
