import collections
import itertools
import random
import time

import oracle_check
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm import extraction, preferences, queries
from packetflow.llm.extraction import Weights, best_run, main_text

PLAIN = Weights({})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-3, 3), max_size=12))
def test_run_is_the_best_of_all(weights):
    begin, end = best_run([float(w) for w in weights])
    best = max((sum(weights[i:j]) for i, j in itertools.combinations(range(len(weights) + 1), 2)), default=0)
    assert sum(weights[begin:end]) == max(best, 0)


def page(rng, i, marked=True):
    words = [f"w{k}" for k in range(200)]

    def some(a, b):
        return " ".join(rng.choices(words, k=rng.randrange(a, b)))

    blocks = [some(3, 8), *(some(1, 60) for _ in range(rng.randrange(2, 8)))]
    tag = "article" if marked else "div"
    inner = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b.replace(' ', rng.choice([' ', chr(10) + ' ']), 2)}" + rng.choice(["</p>", ""]) for b in blocks[1:])
    advert = f'<div class="ad">{some(5, 12)}</div>'
    html = (
        f"<html><head><title>{some(2, 4)}</title><script>if (a < b) x('</p>')</script></head><body><nav><ul>"
        + "".join(f"<li><a href='/{k}'>{some(1, 3)}</a></li>" for k in range(6))
        + f"</ul></nav>{advert}<{tag}>{inner}</{tag}><footer>&copy; {some(4, 9)}</footer></body></html>"
    )
    return html, "\n".join(blocks)


def test_articles_are_extracted_also_where_nothing_marks_them(spark):
    rng = random.Random(4)
    pages = [page(rng, i, marked=i % 3 > 0) for i in range(90)]
    frame = spark.createDataFrame([(i, f"u{i}", h, "x") for i, (h, _) in enumerate(pages)], "page_id long, url string, html string, text string")
    weights = extraction.train(frame)
    got = extraction.extract(frame, weights).collect()
    assert {r.page_id: r.text for r in got} == {i: t for i, (_, t) in enumerate(pages)}
    assert all(r.n_chars == len(r.text) and r.url == f"u{r.page_id}" for r in got)


def test_what_is_left_out_inside():
    html = (
        "<article><h1>A &amp; B</h1><p>One\n two&nbsp;&#233;.<aside>Side words here</aside></p>"
        "<form>Your name <input></form><p>Three <b>four</b>five<br>six &lt;p&gt; 1 < 2</p>"
        "<div class='comments'><p>First! Very nice indeed.</p></div><style>p {}</style><!-- no --></article>"
    )
    assert main_text(html, PLAIN) == "A & B\nOne two é.\nThree fourfive six <p> 1 < 2"


def test_links_in_articles_stay_where_links_outside_are_learned():
    rng = random.Random(6)

    def some(a, b):
        return " ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(a, b)))

    def links():
        rows = "".join(f"<li><a href=/{k}>{some(2, 5)}</a></li>" for k in range(8))
        return f"<div><h2>{some(2, 4)}</h2><ul>{rows}</ul><table><tr><td>{some(2, 4)}</td></tr></table></div>"

    def article(body, tag="article"):
        return f"<html><body>{links()}<{tag}>{body}</{tag}>{links()}</body></html>"

    counts = [collections.Counter(), collections.Counter()]
    for _ in range(60):
        found = extraction.tokens(article("".join(f"<p>{some(20, 40)}</p>" for _ in range(4))))
        assert extraction.is_labelled(found)
        for t in found:
            counts[t.marked][t.key] += max(t.words, 1)
    weights = Weights({k: (counts[0][k], counts[1][k]) for k in counts[0] | counts[1]})
    assert all(weights.known[f"text {k}"] < 0 for k in ("a", "td", "h2"))
    for tag in ("article", "div"):
        a, b, c, d, e = (some(20, 40) for _ in range(5))
        body = (
            f"<p><a href=/1>Start here</a> {a}</p><h2>Part two</h2><p>{b} see <a href=/2>this page</a> now</p>"
            f"<ul><li>{c}</li><li>short one</li></ul><table><tr><td>cell</td></tr></table>"
            f"<p>{d} where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><p>{e} more in <a href=/3>that other page</a></p>"
        )
        wanted = [f"Start here {a}", "Part two", f"{b} see this page now", c, "short one", "cell", f"{d} where x=1 holds", f"{e} more in that other page"]
        assert main_text(article(body, tag), weights).split("\n") == wanted


def test_formulas_are_text():
    many = "<mrow>" + "<mi>y</mi><mo>+</mo>" * 40 + "<mn>2</mn></mrow>"
    html = f"<article><p>One <math display=block>{many}<mspace/><annotation>y+</annotation></math> two</p><p>three <math><mi>z<p>four</p></article>"
    assert main_text(html, PLAIN) == f"One {'y+' * 40}2 two\nthree z\nfour"


def test_inserts_are_known_by_their_names():
    inserts = [
        "<section id='comments'><h3>Readers say</h3><p>Very good indeed.</p></section>",
        "<ol class=commentlist><li>First one here</li></ol>",
        '<div class="cookie-notice">We use cookies</div>', "<div class='Sidebar left'><p>Other news of today</p></div>",
        '<div role="navigation"><a href="/">Home</a></div>', "<footer>All rights</footer>", "<select><option>One</select>",
    ]
    rng = random.Random(2)
    for _ in range(30):
        blocks = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(5, 30))) for _ in range(5)]
        body = "".join(f"<p>{b}</p>" + rng.choice(["", rng.choice(inserts)]) for b in blocks)
        html = f"<header class=top><b>Site name</b></header><article class='post comments-open'>{body}</article>{inserts[0]}"
        assert main_text(html, PLAIN) == "\n".join(blocks)


BODY = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize(
    "html",
    [
        f'<div class="no-sidebar"><article><p>{BODY}</p></article></div>',
        f'<div id="content" class="site-content with-sidebar"><main><p>{BODY}</p></main></div>',
        f'<div class="has-share"><p>{BODY}</p></div>',
        f'<div class="ad-free"><p>{BODY}</p></div>',
        f'<div class="post header-large"><p>{BODY}</p></div>',
        f'<div id="notice-board"><p>{BODY}</p></div>',
        f'<main class="content related"><p>{BODY}</p></main>',
        f'<form action="/"><input type="hidden" name="state"><article><p>{BODY}</p></article></form>',
        f'<form action="/"><input type="hidden" name="state"><div><p>{BODY}</p></div></form>',
        f'<div class="widget"><p>{BODY}</p></div>',
        f'<div class="comments"><main><p>{BODY}</p></main></div>',
    ],
)
def test_wrappers_of_the_article_lose_nothing(html):
    around = "<nav><a href='/'>Home</a> <a href='/b'>Blog</a></nav>{}<footer>Legal notes</footer>"
    assert main_text(around.format(html), PLAIN) == BODY


def test_tables_and_definitions_in_an_article_stay():
    html = (
        f"<article><p>{BODY}</p><table class='widget'><tr><td>cell</td></tr></table>"
        "<dl><dt>term</dt><dd class='notice'>meaning</dd></dl><p class='notice'>Careful!</p>"
        "<form><p>No field here.</p></form><div class='share-buttons'>Send it on</div>"
        "<form>Your mail <input></form><section id='comments'>" + "<p>Me first!</p>" * 90 + "</section></article>"
    )
    assert main_text(html, PLAIN).split("\n")[1:] == [
        "cell", "term", "meaning", "Careful!", "No field here.",
    ]


def test_remarks_of_readers_are_no_article():
    remarks = "".join(f"<article class='comment'><p>I say {i} times no to it.</p></article>" for i in range(40))
    html = f"<div class='post'><p>{BODY}</p></div><div id='comments'>{remarks}</div>"
    assert main_text(html, PLAIN) == BODY


@pytest.mark.parametrize("odd", ["<svg/>", "<div></b>", "<i></p></u>", "<math><p>", "<select/>", "<a", "</x>"])
def test_work_grows_with_the_page(odd):
    def seconds(n):
        text = odd * n
        begin = time.process_time()
        main_text(text, PLAIN)
        return time.process_time() - begin

    seconds(10)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.02)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (4, "u", "<p>word <b <i>" + "<" * 50), (5, "u", "no tags at all"),
            (6, "u", "<div>" * 3000 + "deep words" + "</div>" * 10), (7, "u", "<nav>menu only</nav>"), (5, "u", "no tags at all"),
            (8, "u", "<p>" + "long " * 200_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = extraction.train(frame)
    got = extraction.extract(frame, weights).collect()
    assert [r.text for r in got[:3]] == ["", "", ""] and got[3].text.startswith("word")
    assert [r.text for r in got[4:8]] == ["no tags at all", "deep words", "", "no tags at all"]
    assert got[8].n_chars == 999_999
    assert extraction.extract(frame.limit(0), extraction.train(frame.limit(0))).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-p\"' =abdiv&;#9", max_size=60))
def test_any_text_is_read_to_its_end(text):
    main_text(text, PLAIN)


def sides(spark, chosen, rejected):
    schema = "pair_id long, turn long, role string, text string, part string"
    return [spark.createDataFrame([(*r, "x") for r in side], schema) for side in (chosen, rejected)]


def plain_segments(chosen, rejected):
    laid = {}
    for n, side in enumerate((chosen, rejected)):
        for pair, turn, role, text in side:
            if pair is not None and turn is not None:
                said = (role or "", text or "")
                held = laid.setdefault(pair, ({}, {}))[n]
                held[turn] = min(held.get(turn, said), said)
    rows = []
    for pair, (a, b) in laid.items():
        if not a or not b:
            continue
        end = min((t for t in a.keys() | b.keys() if a.get(t) != b.get(t)), default=None)
        for t in a.keys() | b.keys():
            for part, side in (("prompt", a),) if end is None or t < end else (("chosen", a), ("rejected", b)):
                if t in side:
                    role, text = side[t]
                    head = f"<|im_start|>{role}\n"
                    trained = len(head) if part != "prompt" and role == "assistant" else None
                    rows.append((pair, part, t, role, head + text + "<|im_end|>\n", trained, end))
    return rows


def test_segments_equal_plain_code(spark):
    rng = random.Random(7)
    chosen, rejected = [], []
    for pair in range(40):
        turns = [(pair, t, ["user", "assistant"][t % 2], f"t{rng.randrange(99)}") for t in range(rng.randrange(1, 7))]
        other = [list(t) for t in turns[: rng.randrange(1, len(turns) + 1)]]
        if rng.random() < 0.7:
            other[rng.randrange(len(other))][3] = "changed"
        chosen += turns
        rejected += [tuple(t) for t in other]
    chosen += [(90, 0, None, None), (91, 0, "user", "alone"), (None, 0, "user", "x"), (92, None, "user", "x"), (90, 1, "assistant", "b"), (90, 1, "assistant", "a")]
    chosen += [(95, t, "user", "long " * 5) for t in range(500)]
    rejected += [(90, 0, "", ""), (95, 499, "assistant", "é")]
    frames = sides(spark, chosen, rejected)
    got = preferences.preference_segments(*frames).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_segments(chosen, rejected)))
    empty = preferences.preference_segments(frames[0].limit(0), frames[1])
    assert empty.collect() == []


def test_rows_of_a_pair(spark):
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "same")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "user", "why"), (2, 0, "user", "same")]
    segments = preferences.preference_segments(*sides(spark, chosen, rejected))
    rows = {r.pair_id: r for r in preferences.preference_rows(segments).collect()}
    one = rows[1]
    assert one.prompt == "<|im_start|>user\nq<|im_end|>\n"
    assert [one.chosen[s.start : s.end] for s in one.chosen_spans] == ["good<|im_end|>\n"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["bad<|im_end|>\n"]
    assert one.rejected.endswith("why<|im_end|>\n")
    assert (rows[2].chosen, rows[2].rejected, rows[2].chosen_spans) == ("", "", [])


def test_no_python_in_the_plan(spark, sf_dir):
    pieces = preferences.preference_pieces(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    plan = pieces._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("step", [2, 4096])
def test_pieces_put_together_are_the_rows_of_pairs(spark, step):
    rng = random.Random(11)
    rows = [
        (k, t, ["user", "assistant"][t % 2], "same" if t < k % 4 else f"é{rng.randrange(9)}")
        for k in range(12) for t in range(k % 5 + 1)
    ]
    rows += [(50, t, "user", "long") for t in range(300)] + [(50, 301, "assistant", "end")]
    rows += [(None, 0, "user", "x"), (3, None, "user", "x"), (4, 0, None, None), (4, 0, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wanted = {r.pair_id: r for r in preferences.preference_pairs(frame).collect()}
    parts = collections.defaultdict(list)
    for r in preferences.preference_pieces(frame, step=step).collect():
        parts[r.pair_id, r.part].append(r)
    assert {pair for pair, _ in parts} == set(wanted)
    for (pair, part), pieces in parts.items():
        pieces.sort(key=lambda r: r.turn)
        assert [p.start for p in pieces] == [
            len("".join(q.rendered for q in pieces[:i])) for i in range(len(pieces))
        ]
        row = wanted[pair]
        assert "".join(p.rendered for p in pieces) == row[part]
        spans = [(p.trained_start, p.trained_end) for p in pieces if p.trained_start is not None]
        assert spans == ([] if part == "prompt" else [(s.start, s.end) for s in row[f"{part}_spans"]])
    assert preferences.preference_pieces(frame.limit(0)).collect() == []


def test_ranked_pairs_drop_no_conversation_and_no_turn(spark):
    rows = [(k * 1000, t, "system" if t == 0 else ["user", "assistant"][t % 2], "same" if t < k % 3 else f"{k} {t}")
            for k in range(9) for t in range(k % 3 + 2)]
    rows += [(500, 0, "user", "no reply"), (8000, 9, "user", "after the reply"), (10**12, 0, "assistant", "far")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    replied = sorted({r[0] for r in rows if r[2] == "assistant"})
    assert len(replied) > 5
    partner = dict(zip(replied, replied[1:] + replied[:1], strict=True))
    chosen, rejected = preferences.ranked_pairs(frame)
    wanted = [[(p, *r[1:]) for p in replied for r in rows if r[0] == side(p)] for side in (lambda p: p, partner.get)]
    assert sorted(map(tuple, chosen.collect())) == sorted(wanted[0])
    assert sorted(map(tuple, rejected.collect())) == sorted(wanted[1])
    pairs = preferences.preference_pairs(frame)
    assert "Python" not in pairs._jdf.queryExecution().toString()
    got = {r.pair_id: r for r in pairs.collect()}
    assert sorted(got) == replied and len({r.prompt for r in got.values()}) > 1
    for pair, row in got.items():
        for text, spans, conv in ((row.chosen, row.chosen_spans, pair), (row.rejected, row.rejected_spans, partner[pair])):
            whole = "".join(f"<|im_start|>{r[2]}\n{r[3]}<|im_end|>\n" for r in sorted(r for r in rows if r[0] == conv))
            assert row.prompt + text == whole
            assert all(text[s.start : s.end].endswith("<|im_end|>\n") for s in spans)
    alone = preferences.ranked_pairs(frame.filter("conv_id = 1000000000000"))
    assert [side.collect() for side in alone] == [[], []]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle_check.compare(spark, oracle_check.connect(sf_dir), name, sf_dir) is None
