"""Whole project audits against a plain walk, with odd rows and on empty tables."""

from attestra.operators import project_audits as P

PROJECT = "project string, name string, organization string, item_id string, review_date string, composite_score long, agreements array<string>, has_token boolean, markets int, research_lead string"
CATEGORY = "project string, category string, seq int, score_pct long, numerator double, denominator double, raw_numerator long, raw_denominator long, line_count long, cluster_count long"
CHUNK = "project string, chunk_id long, source_kind string, domain string, doc_title string, score string"
LINE = ("project string, line_id string, seq long, source_kind string, domain string, doc_title string, verdict string, text string, verbatim_quote string, rationale string, category string, line_type string, "
        "weight double, effective_weight double, cluster_size long, citations array<string>, retrieved_works array<struct<openalex_id: string, title: string, year: int, cited_by_count: int>>")

PROJECTS = [("p", "Project", None, "7_1", "June 1, 2026", 55, ["Assignment Agreement"], True, 0, "Anon"),
            ("q", None, "Org", None, None, None, None, None, None, None),
            ("r", "Third", "Org", "", "May", 1, ["Development Agreement"], True, 2, "A. Person")]
CATEGORIES = [("p", "team_credibility", 2, None, None, None, None, None, None, None), ("p", "mission_clarity", 1, 40, 1.005, 0.125, 2, 5, 9, 4), ("r", "b", -1, 3, 1.0, 2.0, 1, 2, 3, 4), ("z", "left", 1, 3, 1.0, 2.0, 1, 2, 3, 4)]
CHUNKS = [("p", 2, "pdf", None, "b.pdf", "x"), ("p", 1, "pdf", "", "b.pdf", "x"), ("p", 3, "crawl_md", "site.org", "t", "x"), ("p", 4, "onchain_fact", None, None, "x"), ("p", 5, "image_caption", None, "", "x"),
          ("p", 6, "text_doc", "d.org", "f", "x"), ("p", 7, None, " e.org ", "g", "x"), ("p", 8, None, None, None, "x"), ("r", 9, "video_transcript", None, "talk", "x"), ("r", 10, "pdf", None, "a", "x"),
          ("r", 11, "crawl_md", "c", "a", "x"), ("z", 1, "pdf", None, "a", "x")]
W = [("W1", "A title " * 40, 2001, 3), ("W2", None, None, None), ("", "no id", 1, 1)]
LINES = [("p", f"l{i}", i, "pdf", None, "b.pdf", ("valid", "negative", "positive", "neutral", "invalid", "inconclusive", None, "odd")[i % 8], f" text {i} é ", ("TEXT %d é" % i, " said ", None, "")[i % 4],
          (None, " why\nso ")[i % 2], "mission_clarity", (None, "fact")[i % 2], 1.005 + i, (None, 0.125)[i % 2], i % 3, (None, [], ["W2", "W1"], ["W1", "W1", None])[i % 4], (W, None, [("W1", "later", 1, 1)])[i % 3]) for i in range(40)]
LINES += [("p", None, 50, "crawl_md", "site.org", "t", "positive", None, None, None, None, None, None, None, None, ["W9"], None), LINES[0],
          ("p", "u", 51, "pdf", None, "never read", "valid", "hidden", None, None, "c", "t", 1.0, 1.0, 1, ["W3"], [("W3", "T3", 0, 0)]),
          ("p", "n", 52, "text_doc", None, "f", "neutral", "n", None, None, "c", "t", 1.0, 1.0, 1, None, None), ("z", "x", 1, "pdf", None, "a", "valid", "z", None, None, "c", "t", 1.0, 1.0, 1, ["W1"], W)]
TAKEN = [("p",)] * 3 + [("z",)]


def key_of(kind, domain, title):
    kind, domain, title = kind or "", domain or "", title or ""
    if kind == "onchain_fact":
        return "onchain"
    if kind == "crawl_md" and domain:
        return f"crawl::{domain}"
    return {"pdf": "pdf", "image_caption": "image", "video_transcript": "video", "video_frame": "video", "text_doc": "text"}.get(kind, kind) + f"::{title}"


def names_of(kind, domain, title, page):
    kind, domain, title = kind or "", (domain or "").strip(), (title or "").strip()
    if kind == "crawl_md" and domain:
        return domain, f"https://{domain}/"
    head = {"pdf": ("Dataroom PDF · ", "PDF"), "image_caption": ("Dataroom image · ", "image"), "video_transcript": ("Dataroom video · ", "video"), "text_doc": ("Dataroom file · ", "")}
    if kind == "onchain_fact":
        return "IPNFT on-chain profile", page
    if kind in head:
        return head[kind][0] + (title or head[kind][1]), page
    return (domain, f"https://{domain}/") if domain else (title or kind or "source", page)


def walk(project, lines, chunks, per_source):
    key, name, org, item, date, score, agreements, token, markets, lead = project
    mine = lambda rows: [r for r in rows if r[0] == key]
    lines, chunks = sorted(mine(lines), key=lambda r: r[2]), sorted(mine(chunks), key=lambda r: r[1])
    page = f"https://example.org/ipnft/{item}" if item else "https://example.org/"
    verdicts = [r[6] or "neutral" for r in lines]
    good, bad = sum(v in ("valid", "positive") for v in verdicts), sum(v in ("invalid", "negative") for v in verdicts)
    out = [f"# Evidence audit · {name or 'Unknown'}", "", f"**Organization:** {org or 'Unknown'}  ", *([f"**IPNFT page:** [{page}]({page})  "] if item else []), f"**Review date:** {date or '?'}  ",
           f"**Composite score:** {'(none)' if score is None else score} / 100  ", "", *P.INTRO, "", "---", "", "## At a glance", ""]
    out += [f"- Sources reviewed: **{len({key_of(*c[2:5]) for c in chunks})}**", f"- Lines extracted from those sources: **{len(mine(TAKEN))}**",
            f"- Lines that produced a clear verdict: **{good + bad}** ({good} favorable, {bad} unfavorable)", f"- Lines whose science could not be confirmed: **{verdicts.count('inconclusive')}**", "", "---", ""]
    out += ["## Category scores", "", *P.CATEGORY_TABLE]
    for _, cat, _, pct, a, b, *n in sorted(mine(CATEGORIES), key=lambda r: r[2]):
        n = [x or 0 for x in n]
        out.append(f"| {cat} | {'n/a' if pct is None else pct} | {a or 0:.2f} / {b or 0:.2f} | {n[0]} / {n[1]} | {n[2]} | {n[3]} |")
    out += ["", *P.SCORING, "", "---", "", "## Sources reviewed", "", *P.SOURCES, ""]
    order = lambda k: (next((i for i, p in enumerate(P.SOURCE_ORDER) if k.startswith(p)), 5), k)
    for source in sorted({key_of(*c[2:5]) for c in chunks}, key=order):
        read, got = [c for c in chunks if key_of(*c[2:5]) == source], [r for r in lines if key_of(*r[3:6]) == source]
        label, url = names_of(*read[0][2:5], page)
        all_of = [r[6] or "neutral" for r in got]
        out += [f"### {label}", "", f"**Link:** [{url}]({url})  ", f"**Chunks read:** {len(read)} · **Lines extracted:** {len(got)} · **Verdicts:** " + (", ".join(f"{v}={all_of.count(v)}" for v in sorted(set(all_of))) or "—"), ""]
        listed = sorted([r for r in got if r[6] in P.LISTED], key=lambda r: P.LISTED.index(r[6]))
        if not listed:
            out += [P.NO_VERDICTS, ""]
            continue
        for _, line, _, _, _, _, v, text, quote, why, cat, kind, weight, effective, size, cites, _ in listed[:per_source]:
            text, quote, why, weight = (text or "").strip(), (quote or "").strip(), (why or "").strip(), weight or 0
            mark = {"valid": "✅", "positive": "✅", "invalid": "❌", "negative": "❌", "inconclusive": "❓"}[v]
            note = f" · cluster ×{size}" if size and size > 1 else ""
            out.append(f"- {mark} **{v}** · `#{line or '?'}` · _{(cat or '').replace('_', ' ')} · {kind or '?'} · weight {weight:.2f} → eff {weight if effective is None else effective:.2f}{note}_ — {text}")
            out += [f"    > {quote}"] if quote and quote.lower() != text.lower() else []
            out += ["    Supporting literature: " + ", ".join(f"[{c}](https://openalex.org/{c})" for c in cites if c)] if cites else []
            out += [f"    *Validator note:* {why}"] if why else []
        out += [f"- _… {len(listed) - per_source} additional scored line(s) omitted._"] if len(listed) > per_source else []
        out.append("")
    out += ["---", "", "## Scientific literature consulted", ""]
    refs, works = {}, {}
    for r in lines:
        for c in r[15] or []:
            if c:
                refs.setdefault(c, []).append(f"#{r[1] or '?'}")
        for w in r[16] or []:
            works.setdefault(w[0], w)
    out += [*P.LITERATURE, "", *P.WORK_TABLE] if refs else [P.NO_CITATIONS]
    for c in sorted(refs):
        _, title, year, n = works.get(c, (c, None, None, None))
        out.append(f"| [{(title or '(unknown)')[:160]}](https://openalex.org/{c}) | {year or '—'} | {'—' if n is None else n} | {', '.join(refs[c])} |")
    kinds = {c[2] for c in chunks}
    lacks = {"agreements": not agreements, "development": bool(agreements) and "Development Agreement" not in agreements, "token": not token, "markets": bool(token) and not markets,
             "lead": (lead or "").lower() in P.HIDDEN_NAMES, "pdf": "pdf" not in kinds, "crawl": "crawl_md" not in kinds, "video": "video_transcript" not in kinds}
    out += ["", "---", "", "## What's missing", "", *([f"- {P.GAPS[k]}" for k, v in lacks.items() if v] or [P.NO_GAPS]), "", "---", "", "*Generated by the review pipeline.*", ""]
    return "\n".join(out)


def frames(spark, empty=()):
    tables = {"projects": (PROJECTS, PROJECT), "categories": (CATEGORIES, CATEGORY), "chunks": (CHUNKS, CHUNK), "extracted": (TAKEN, "project string"), "lines": (LINES, LINE)}
    return {name: spark.createDataFrame([] if name in empty else rows, schema).repartition(3) for name, (rows, schema) in tables.items()}


def test_documents_follow_the_walk(spark):
    for per_source in (12, 3):
        got = {r.project: (r.bytes, r.text) for r in P.project_document("project", **frames(spark), per_source=per_source).collect()}
        want = {p[0]: walk(p, LINES, CHUNKS, per_source) for p in PROJECTS}
        for k, text in want.items():
            assert got[k][1].split("\n") == text.split("\n")
        assert got == {k: (len(t.encode()), t) for k, t in want.items()}


def test_no_rows(spark):
    assert P.project_document("project", **frames(spark, ("projects",))).count() == 0
    alone = {r.project: r.text for r in P.project_document("project", **frames(spark, ("categories", "chunks", "extracted", "lines"))).collect()}
    assert set(alone) == {"p", "q", "r"} and all(P.NO_CITATIONS in t and P.GAPS["pdf"] in t and "Sources reviewed: **0**" in t for t in alone.values())
