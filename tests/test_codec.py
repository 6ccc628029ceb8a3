import base64

import pytest
from pyspark.sql import functions as F

from cardweave.functions.envelope import PREFIX
from cardweave.functions.keys import resolve_key
from cardweave.operators.codec import decrypt_feed, encrypt_feed
from cardweave.sinks.topic import publish_records

KEY = b"0123456789abcdef"
# Made with the JDK, IV bytes 0 to 11.
VECTOR = "aes-gcm-v1:AAECAwQFBgcICQoL:wXulaX9K+J/UCUN7tPqOMotD3DALs1zSmB2mjBdtsA=="


def decrypted(feed, key=KEY):
    rows = decrypt_feed(feed, key).orderBy("offset").collect()
    return [(r["value"], r["decrypt_failed"]) for r in rows]


@pytest.mark.parametrize("size", [16, 24, 32])
def test_round_trip(feed_of, size):
    key = bytes(range(size))
    values = ["<Data>é</Data>", "", " ", "x" * 10_000, None, "a:b:c", "emoji \U0001f600"]
    sealed = encrypt_feed(feed_of(values), key)
    assert decrypted(sealed, key) == [(v, False) for v in values]


def test_envelope_form(feed_of):
    rows = encrypt_feed(feed_of(["same text"] * 200), KEY).collect()
    ivs = set()
    for row in rows:
        assert row["value"].startswith(PREFIX)
        iv, sealed = row["value"][len(PREFIX) :].split(":")
        assert len(base64.b64decode(iv, validate=True)) == 12
        assert len(base64.b64decode(sealed, validate=True)) == len("same text") + 16
        ivs.add(iv)
    assert len(ivs) == len(rows)


def test_known_envelope(feed_of):
    assert decrypted(feed_of([VECTOR])) == [("<Data>é</Data>", False)]


def test_missing_padding_is_accepted(feed_of):
    assert decrypted(feed_of([VECTOR.rstrip("=")])) == [("<Data>é</Data>", False)]


def test_plain_text_passes(feed_of):
    values = ["<Data/>", "", None, "aes-gcm-v1", " " + VECTOR, "AES-GCM-V1:x:y"]
    assert decrypted(feed_of(values)) == [(v, False) for v in values]


def test_damaged_envelopes_are_kept_and_flagged(feed_of):
    body = VECTOR[len(PREFIX) :]
    iv, sealed = body.split(":")
    damaged = [
        PREFIX,
        PREFIX + iv + sealed,
        VECTOR[:-6],
        VECTOR[:-4] + "AA==",
        VECTOR.replace("wXu", "wXv"),
        VECTOR.replace("AAEC", "AA*C"),
        VECTOR + "\r\n",
        PREFIX + iv + ":" + sealed[:10] + "\n" + sealed[10:],
        PREFIX + iv[:-4] + ":" + iv[-4:] + sealed,
        PREFIX + iv + ":",
        VECTOR + "=",
    ]
    assert decrypted(feed_of(damaged)) == [(v, True) for v in damaged]


def test_wrong_key(feed_of):
    assert decrypted(feed_of([VECTOR]), b"fedcba9876543210") == [(VECTOR, True)]


def test_key_stays_out_of_plans(feed_of):
    key = b"ThisIsTheSecret!"
    for df in (encrypt_feed(feed_of(["a"]), key), decrypt_feed(feed_of([VECTOR]), key)):
        df.collect()
        text = df._jdf.queryExecution().toString()
        for form in (key.decode(), key.hex(), key.hex().upper(), base64.b64encode(key).decode()):
            assert form not in text


def test_publishing_with_and_without_a_key(feed_of):
    feed = feed_of(["<Data/>", None])
    assert [tuple(r) for r in publish_records(feed).collect()] == [(None, "<Data/>"), (None, None)]
    sealed = publish_records(feed, KEY)
    assert sealed.columns == ["key", "value"]
    assert sealed.filter(F.col("value").startswith(PREFIX)).count() == 1


def test_key_precedence():
    b64 = lambda text: base64.b64encode(text.encode()).decode()
    one, two, three, four = ("1" * 16, "2" * 16, "3" * 16, "4" * 16)
    config = {"crypto.key-base64": b64(one), "crypto.key": three}
    env = {"KAFKA_SYMMETRIC_KEY_BASE64": b64(two), "KAFKA_SYMMETRIC_KEY": four}
    assert resolve_key(config, env) == one.encode()
    assert resolve_key({**config, "crypto.key-base64": " \t"}, env) == two.encode()
    assert resolve_key(config | {"crypto.key-base64": ""}, {"KAFKA_SYMMETRIC_KEY": four}) == three.encode()
    assert resolve_key({}, {"KAFKA_SYMMETRIC_KEY": four}) == four.encode()
    assert resolve_key({}, {"KAFKA_SYMMETRIC_KEY_BASE64": b64(one).rstrip("=")}) == one.encode()


@pytest.mark.parametrize(
    "config",
    [{}, {"crypto.key": "  "}, {"crypto.key": "short"}, {"crypto.key-base64": "not base64!"}, {"crypto.key": "é" * 15}],
)
def test_bad_keys(config):
    with pytest.raises(ValueError):
        resolve_key(config, {})


def test_text_keys_count_bytes():
    assert len(resolve_key({"crypto.key": "é" * 8}, {})) == 16
