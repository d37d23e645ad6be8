"""Small tables with everything that may go wrong in them."""

from predial.llm.support import prepare

SF = "/root/testdata/sf0.001"
LONG = "palabra tras palabra " * 40_000

# The columns besides those of documents have names that operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, "
    "salt int, score double, kept boolean, component_id long, signature long, slot string, "
    "spans string, length int, bucket string, nth int"
)

TEXTS = [
    (1, "Uno dos tres cuatro cinco seis siete ocho nueve diez once doce"),
    (2, "uno DOS tres cuatro cinco seis siete ocho nueve diez once doce trece"),
    (3, "same words"),
    (9, "same words"),
    (4, "same words"),
    (5, None),
    (6, ""),
    (7, "   \n\t "),
    (8, LONG),
    (10, "write to ana.b@mail.example.com or +1 (555) 010-2345 from 10.0.0.1, 4111 1111 1111 1111"),
    (11, "été 中文 \U0001f642 ́x"),
    (12, "x" * 5000),
    (None, "no id here"),
    (None, None),
    (13, "12345 67890"),
    (3, "same words"),  # a repeated row
]


def row(doc_id, text):
    return (doc_id, text, None, None, None, "d", 1, 0.5, True, 7, 8, "s", None, 3, "b", 4)


def documents(spark):
    return prepare(spark).createDataFrame([row(*t) for t in TEXTS], SCHEMA).repartition(3)


def no_documents(spark):
    return prepare(spark).createDataFrame([], SCHEMA)
