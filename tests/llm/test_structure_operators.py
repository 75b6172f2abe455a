"""Whitening, license templates and conversation repair against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from ratewell.llm import dialogue
from ratewell.llm.dialogue import damage, digests, repair
from ratewell.llm.licenses import compiled, scan_licenses
from ratewell.llm.license_texts import TEMPLATES
from ratewell.llm.queries import op11_embedding_whitening, op12_license_scan, op13_conversation_repair
from ratewell.llm.whitening import as_longs, usable, whiten

# -- whitening ----------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, x int, n string, component double"


def as_vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 0.5) for i, v in rows], VECTORS)


def run_whitening(frame, keep=16):
    found, fit = whiten(frame.where(usable()).select("vec_id", as_longs().alias("x")), keep)
    return found.toPandas(), fit


def plain_whitening(rows, keep=16):
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([np.floor(64 * np.array(v, dtype=float)) + 1_000_000 for _, v in good]).astype(np.int64)
    listed = np.unique(x, axis=0)
    n, sums = len(listed), listed.sum(0)
    centred = (listed * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:keep], vectors[:, ::-1][:, :keep]
    return [i for i, _ in good], n, ((x * n - sums) ** 2).sum(1), (x * n - sums) / n @ vectors / np.sqrt(values), values


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + k, rows[0][1]) for k in range(40)]  # a group of copies
    rows += [(None, rows[1][1]), (2, rows[2][1])]
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf")] * 5), (205, [1.0, 2.0])]
    return rows, odd


def test_whitening_equals_numpy(spark, vector_rows):
    rows, odd = vector_rows
    found, fit = run_whitening(as_vectors(spark, rows + odd).repartition(3))
    ids, n, deviations, whitened, values = plain_whitening(rows)
    assert fit.n == n == 60 and fit.identity_error < 1e-10
    assert np.allclose(fit.values, values)
    assert len(found) == 5 * len(rows)
    wide = found.fillna({"vec_id": -1}).groupby(["vec_id", "component"]).whitened.mean().unstack()
    plain = pd.DataFrame(whitened, index=[-1 if i is None else i for i in ids]).groupby(level=0).mean()
    signs = np.sign((wide.to_numpy() * plain.to_numpy()).sum(0))
    assert np.allclose(wide.to_numpy(), plain.to_numpy() * signs, atol=1e-9)
    by_id = found.fillna({"vec_id": -1}).groupby("vec_id").deviation
    assert (by_id.max() == by_id.min()).all()
    assert all(by_id.max()[-1 if i is None else i] == d for i, d in zip(ids, deviations))


def test_whitening_of_odd_tables(spark, vector_rows):
    empty, fit = run_whitening(as_vectors(spark, []))
    assert empty.empty and fit is None
    equal, fit = run_whitening(as_vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert equal.empty and fit.n == 1
    flat, fit = run_whitening(as_vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(8)]))
    assert set(flat.component) == {1} and fit.identity_error < 1e-10  # one direction only
    huge, fit = run_whitening(as_vectors(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [3.0, 5.0])]))
    assert len(huge) == 3 * len(fit.values) and huge.deviation.isna().sum() == 2 * len(fit.values)


def test_whitening_by_many_blocks(spark, monkeypatch, vector_rows):
    monkeypatch.setattr("ratewell.llm.whitening.SMALL", 7 * 5 * 8)  # seven rows a block
    rows, _ = vector_rows
    _, _, _, whitened, _ = plain_whitening(rows)
    found, fit = run_whitening(as_vectors(spark, rows).repartition(4), keep=3)
    assert set(found.component) == {1, 2, 3} and fit.identity_error < 1e-10
    assert np.isclose(np.abs(found.whitened).sum(), np.abs(whitened[:, :3]).sum())


def test_whitening_query(spark, sf_dir):
    found = op11_embedding_whitening(spark, sf_dir).toPandas()
    assert set(found.component) == set(range(1, 17)) and found.identity_error.max() < 1e-4
    assert found.groupby("component").explained.first().is_monotonic_decreasing


# -- license templates --------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def as_regex(markup):
    """The template as a pattern over words that are each followed by one blank."""
    out = ""
    for k, part in enumerate(re.split(r"<<(.*?)>>", markup, flags=re.S)):
        if k % 2 == 0:
            out += "".join(re.escape(w) + " " for w in license_words(part))
        elif part == "beginOptional":
            out += "(?:"
        elif part == "endOptional":
            out += ")?"
        else:
            key, _, value = part.split(";")[-1].partition("=")
            if key == "words":
                out += r"(?:[^ ]+ ){%s,%s}" % tuple(value.split("-"))
            else:
                out += "(?:" + "|".join("".join(w + " " for w in license_words(way)) for way in value.split("|")) + ")"
    return re.compile("(?<![^ ])" + out)


def filled(markup, rng):
    """A text of the template: options taken or not, regions filled."""
    text = ""
    skipping = False
    for k, part in enumerate(re.split(r"<<(.*?)>>", markup, flags=re.S)):
        if part == "beginOptional":
            skipping = rng.random() < 0.5
        elif part == "endOptional":
            skipping = False
        elif skipping:
            continue
        elif k % 2 == 0:
            text += part
        else:
            key, _, value = part.split(";")[-1].partition("=")
            if key == "words":
                text += " " + " ".join(rng.choice(["acme", "the", "Ünïcode", "license", "x1"]) for _ in range(rng.randint(*map(int, value.split("-"))))) + " "
            else:
                text += " " + rng.choice(value.split("|")) + " "
    return text


def license_texts():
    rng = random.Random(5)
    texts = [None, "", " \t", "under the MIT license", "Under-the MIT\nLicense under the mit license", "CC BY-NC", "cc by", "mit license under the"]
    texts += ["Apache License, Version 2.0 and cc by nc; Apache License Version 2", "naïve under thé mit license", "permission " * 500]
    texts += ["This work is licensed under the GNU General Public License, version 3.", "not licensed under the GNU License version 3"]
    for _, markup in TEMPLATES:
        for _ in range(3):
            whole = filled(markup, rng)
            words = whole.split()
            cut = rng.randrange(len(words))
            texts += [f"Start {whole}, end.", " ".join(words[:cut] + words[cut + 1 :]), " ".join(words[:cut] + ["other"] + words[cut:])]
    return texts + ["lorem ipsum " * 40_000 + "Released under the MIT License."]


def test_templates_equal_regular_expressions(spark):
    texts = license_texts()
    rows = [(i, t, "x", 3, [1]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, n_words int, spans array<int>")
    found = {r["doc_id"]: r for r in scan_licenses(docs.repartition(3)).collect()}
    patterns = [(label, as_regex(markup)) for label, markup in TEMPLATES]
    hits = 0
    for i, text in enumerate(texts):
        words = license_words(text)
        joined = "".join(w + " " for w in words)
        assert found[i]["n_words"] == len(words)
        expected = {label for label, pattern in patterns if pattern.search(joined)}
        assert {s["label"] for s in found[i]["spans"] if s["how"] == "template"} == expected, text
        hits += bool(expected)
        for s in found[i]["spans"]:
            stretch = "".join(w + " " for w in words[s["start"] : s["end"]])
            if s["how"] == "template":
                assert any(label == s["label"] and pattern.fullmatch(stretch) for label, pattern in patterns)
        assert 0 <= found[i]["n_covered"] <= len(words)
    assert hits > len(TEMPLATES)


def test_base_phrases_at_all_places(spark, sf_dir):
    found = op12_license_scan(spark, sf_dir).toPandas().set_index("doc_id")
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = license_words(row["text"])
        places = [(k, x) for x, p in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        mine = found.loc[row["doc_id"]]
        assert (mine.n_words, mine.n_base, mine.base_labels) == (len(words), len(places), ",".join(sorted({x for _, x in places})))
        assert not places or (mine.first_word, mine.last_word) == (min(places)[0], max(places)[0])
        assert set(mine.base_labels.split(",")) - {""} <= set(mine.labels.split(",")) and 0 <= mine.score <= 1


def test_bad_templates_are_refused():
    for markup in ("<<var;x;words=0-3>> license", "<<beginOptional>>a<<endOptional>>", "a <<beginOptional>> b", "a <<var;x;size=3>>"):
        with pytest.raises(ValueError):
            compiled([("x", markup)])


def test_no_licenses_in_no_documents(spark, no_docs):
    assert scan_licenses(no_docs).count() == 0


# -- conversation repair ------------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"
LEADS = {(0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3, (0, "s"): 1}


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(BLANKS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """All edits by search: cost, audit and what is left, of the cheapest and then ASCII-least."""
    faults = plain_faults(rows)
    best = {}

    def search(i, state, inserted):
        if (i, state, inserted) in best:
            return best[i, state, inserted]
        options = [(0, "", [])] if i == len(rows) and state in (0, 3) else []
        if i < len(rows):
            role, text = rows[i]
            cost, audit, left = search(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, left))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                if (state, role[:1]) in LEADS:
                    cost, audit, left = search(i + 1, LEADS[state, role[:1]], 0)
                    options.append((cost + more, "K" + audit, [f"{role}:{text}", *left]))
                for name in ("user", "assistant"):
                    if (state, name[0]) in LEADS:
                        cost, audit, left = search(i + 1, LEADS[state, name[0]], 0)
                        options.append((cost + more + 3, "R" + audit, [f"{name}:{text}", *left]))
        for name in ("user", "assistant"):
            if inserted < 4 and (state, name[0]) in LEADS:
                cost, audit, left = search(i, LEADS[state, name[0]], inserted + 1)
                options.append((cost + 3, "I" + audit, [f"{name}:", *left]))
        best[i, state, inserted] = min(options, key=lambda o: o[:2], default=(1 << 30, "", []))
        return best[i, state, inserted]

    cost, audit, left = search(0, 0, 0)
    return cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


def plain_row(turns):
    """``turns`` of one conversation in order, ``(turn, role, text)`` without nulls in role and text."""
    faults = plain_faults([t[1:] for t in turns])
    initials = [role[:1] for _, role, _ in turns]
    known = [t for t, _, _ in turns if t is not None]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        *plain_repair([t[1:] for t in turns]),
    )


def conversations(many=150):
    rng = random.Random(11)
    rows = []
    for conv in range(many):
        turns = sorted(rng.sample(range(30), rng.randint(1, 9)))
        for turn in turns:
            text = rng.choice(["Hi.", "Why?", "so", "", " \t", f"Number {rng.randint(0, 99)}!", f"cut {rng.randint(0, 99)}", "é. \n"])
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown"]), text))
    rows += [(900, None, "user", "No turn."), (900, 4, None, "a."), (900, 5, "assistant", None), (None, 1, "user", "No id."), (None, 2, "assistant", "Fine.")]
    rows += [(901, 1, "user", "x."), (901, 1, "user", "x."), (901, 1, "assistant", "y.")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, seq int, edit string, t int, cost int"


def as_turns(spark, rows):
    return spark.createDataFrame([(*r, 7, "z", 8, 9) for r in rows], SCHEMA)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def by_conversation(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for turns in groups.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    return groups


def test_repair_equals_search(spark):
    rows = conversations()
    found = digests(repair(as_turns(spark, rows).repartition(4), spark.createDataFrame([(7_000,), (None,), (3,)], "conv_id long"))).collect()
    got = {r["conv_id"]: (*(r[c] for c in COUNTS), r["audit"], r["repaired_sha256"]) for r in found}
    expected = {conv: plain_row(turns) for conv, turns in by_conversation(rows).items()}
    expected[7_000] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert len(found) == len(got)
    assert got == expected


def test_damage_follows_its_lots(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    expected = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        lot = zlib.crc32(key.encode()) % 20
        role, text = role or " ", text or " "
        if lot:
            row = (conv, turn, "user" if lot == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(lot, text))
            expected += [row] * (2 if lot == 3 else 1)
    assert sorted(map(tuple, damage(as_turns(spark, rows)).collect()), key=str) == sorted(expected, key=str)


def test_small_pieces_and_batches_change_nothing(monkeypatch):
    """The two walks by themselves, a conversation over many pieces and batches."""
    rng = random.Random(2)
    rows = [(rng.choice(["user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"{k}!"])) for k in range(300)]
    faults = plain_faults(rows)
    codes = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
    frame = pd.DataFrame(
        {
            "has_id": True, "conv": 5, "has_turn": True, "t": range(300), "role": [r for r, _ in rows], "mark": 0,
            "kind": ["uas".find(r[0]) if r[0] in "uas" else 3 for r, _ in rows], "fault": [codes[f] for f in faults],
            "text": [t for _, t in rows],
        }
    )
    audits = set()
    for piece, batch in ((1 << 16, 300), (7, 10), (1, 1), (300, 299)):
        monkeypatch.setattr(dialogue, "PIECE", piece)
        back = frame[::-1]
        pieces = pd.concat(dialogue._leave_bytes(iter(back[k : k + batch] for k in range(0, 300, batch))))
        assert len(pieces) == -(-300 // piece)
        both = pd.concat([pieces.assign(flag=1, text=None), frame.assign(flag=2, piece=0, back=None)])
        for c in COUNTS:
            both[c] = both[c] if c in both else None
        both = both.sort_values(["t", "flag", "piece"], ascending=[True, True, False], kind="stable")
        messages = pd.concat(dialogue._apply(iter(both[k : k + batch] for k in range(0, len(both), batch))))
        assert (messages.seq == range(len(messages))).all()
        audits.add(("".join(messages.edit.dropna()), int(messages.cost.iloc[0])))
    cost, audit, _ = plain_repair(rows)
    assert audits == {(audit, cost)}


def test_repair_of_nothing(spark):
    assert digests(repair(as_turns(spark, []))).count() == 0


def test_every_pair_of_roles_and_faults():
    """The step table against the definition, for all short conversations."""
    texts = {0: "a.", 1: "b", 2: ""}
    roles = ["user", "assistant", "system", "tool"]
    for kinds in itertools.product(itertools.product(range(4), range(3)), repeat=3):
        rows = [(roles[k], f"{i}{texts[f]}" if f < 2 else "") for i, (k, f) in enumerate(kinds)]
        walk = dialogue._Costs()
        for k, f in reversed(kinds):
            walk.row(k, f, None)
        assert walk.base + walk.relative[0] == plain_repair(rows)[0]


def test_repair_query_covers_all_conversations(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert op13_conversation_repair(spark, sf_dir).count() == turns.select("conv_id").distinct().count()
