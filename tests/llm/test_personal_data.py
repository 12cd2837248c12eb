import random
from collections import Counter

from harborline.llm import personal_data

SCHEMA = "record_id bigint, delivery_instructions string, delivery_notes string, failure_notes string, kind string, instance string"
GIVEN, FAMILY = ["Imre", "Zoë", "Farah", "Björn", "Lotte", "Noor"], ["Varrick", "O'Dunmore", "Eskeland", "Grolmann", "Pell"]


def corpus():
    """Texts with their true items."""
    r, out = random.Random(1), []
    phones = [lambda: f"+1 {r.randrange(200, 999)} 555 01{r.randrange(10, 99)}", lambda: f"{r.randrange(200, 999)}.555.01{r.randrange(10, 99)}", lambda: f"({r.randrange(200, 999)}) 555-01{r.randrange(10, 99)}", lambda: f"{r.randrange(200, 999)}55501{r.randrange(10, 99)}"]
    for _ in range(700):
        g, f = r.choice(GIVEN), r.choice(FAMILY)
        name = r.choice([f"{g} {f}", f"{f}, {g}", f"Mrs {f}", f"{g[0]}. {f}", g.lower(), f"{g} {f}".upper(), f])
        phone = r.choice(phones)()
        local = personal_data.fold(g) + "." + personal_data.fold(f)
        mail = r.choice([f"{local}@mail.example", f"{local} (at) mail (dot) example", f"{local} at mail dot example"])
        street = r.choice([f"{r.randrange(1, 99)} Selhaven Avenue", f"Dunstraße {r.randrange(1, 99)}a", f"Calle Vermoor {r.randrange(1, 99)}", f"flat 3, {r.randrange(1, 99)} Kel Rd"])
        number = f"{r.randrange(100, 999)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}"
        text, items = r.choice([
            (f"Ring {name} at {phone}, the bell is broken.", ["PERSON_NAME", "PHONE"]), (f"Please email {mail} with a window.", ["EMAIL"]), (f"Deliver to side entrance of {street}, not the front.", ["STREET_ADDRESS"]),
            (f"Signed by {name}, showed {r.choice(['SSN ', ''])}{number}.", ["PERSON_NAME", "ID_NUMBER"]), (f"Call {phone} before you come up.", ["PHONE"]), (f"Order {r.randrange(10**5, 10**6)}-88 must stay upright.", []),
            (f"Drop by {f} Freight loading bay.", []), ("Left at rose door, photo taken.", []), (f"Met {g} {f} + {r.choice(GIVEN)} in lobby.", ["PERSON_NAME", "PERSON_NAME"]), (f"Tracking TRK{r.randrange(10**9, 10**10)} scanned twice.", []),
            (f"Handed to {name} at door.", ["PERSON_NAME"]), (f"Gate code is {r.randrange(10**5, 10**6)}.", []), ("Recipient asked [NAME] at [PHONE] to pick up.", []),
        ])
        out.append((text, items))
    return out


def frame(spark, texts):
    return spark.createDataFrame([(n, t, None, None, "clash", "clash") for n, t in enumerate(texts)], SCHEMA)


def test_bootstrapped_items(spark):
    data = corpus()
    found = {}
    for r in personal_data.items(frame(spark, [t for t, _ in data])).collect():
        found.setdefault(r.record_id, []).append(r.pii_type)
    wrong = [(t, want, found.get(n, [])) for n, (t, want) in enumerate(data) if Counter(want) != Counter(found.get(n, []))]
    assert len(wrong) <= 0.01 * len(data), wrong[:5]


def test_masked_texts(spark):
    texts = [t for t, _ in corpus()] + ["Ring Imre Varrick at 555.555.0199, the bell is broken.\n  ", "x" * 200_000 + " Call +1 555 555 0123 now"]
    got = {r.record_id: r.text for r in personal_data.masked(frame(spark, texts)).collect()}
    assert got[700] == "Ring [PERSON_NAME] at [PHONE], the bell is broken.\n  "
    assert got[701] == "x" * 200_000 + " Call [PHONE] now" and len(got) == 702


def test_nulls_repeats_and_empty(spark):
    rows = [(1, None, "", "  ", "a", "b"), (2, "mail a.b@c.de", "mail a.b@c.de", None, "a", "b"), (2, "mail a.b@c.de", "mail a.b@c.de", None, "a", "b"), (None, "x@y.zz", None, None, "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.record_id, r.field_name, r.pii_type, r.item_no) for r in personal_data.items(df).collect())
    assert got == [(2, "delivery_instructions", "EMAIL", 1), (2, "delivery_notes", "EMAIL", 1)]
    assert personal_data.items(df.limit(0)).count() == personal_data.masked(df.limit(0)).count() == 0


def test_shapes():
    assert personal_data.shape("QQ 12 34 56 C") == "AA 99 99 99 A" and personal_data.shape("tel:+15550100") == "tel:+99999999"
    assert personal_data.fold("O'Dünmore-ß") == "odunmoress"


def test_rounds_find_other_forms_and_streets(spark, monkeypatch):
    df = frame(spark, [t for t, _ in corpus()])
    kinds = lambda: Counter(r.pii_type for r in personal_data.items(df).select("pii_type").collect())
    whole = kinds()
    bootstrap = personal_data.bootstrap
    monkeypatch.setattr(personal_data, "bootstrap", lambda found: bootstrap(found, rounds=0))
    seeds = kinds()
    assert seeds["EMAIL"] < 0.6 * whole["EMAIL"] and seeds["STREET_ADDRESS"] < 0.6 * whole["STREET_ADDRESS"]


def test_words_before_a_number_decide(spark):
    # a number of a phone's shape behind words that never stand before phones is none
    r = random.Random(3)
    number = lambda: f"{r.randrange(200, 999)} 555 01{r.randrange(10, 99)}"
    texts = [f"Please call {number()} before noon" for _ in range(300)] + [f"Tel: +1 {number()} rings, please call +1 {number()} before noon" for _ in range(100)]
    texts += [f"Stock order {r.randrange(10**7, 10**8)} in aisle" for _ in range(3000)] + [f"Stock order {number()} in aisle" for _ in range(5)]
    found = {x.record_id for x in personal_data.items(frame(spark, texts)).collect()}
    assert len(found & set(range(400))) == 400 and not found & set(range(400, len(texts)))


def test_labels_at_any_distance():
    (m,) = [m for m in personal_data.mentions("Showed passport number" + " " * 200 + ": 123-45-6789 ok") if m[0] == "number"]
    assert m[5] == "ID_NUMBER"


def test_instances():
    assert personal_data.mail_instance("a.b (at) mail (dot) example") == "(at) spaced mail.example" and personal_data.mail_instance("a@b.c") == "@ b.c"
    assert personal_data.street_instance("12 N. Kel Road.") == "road" and personal_data.street_instance("Dunstraße 4") == "straße" and personal_data.street_instance("21 rue de Vel") == "rue"
