"""SQL for queries whose plans are functions of constants kept elsewhere: generated from the same constants."""

from __future__ import annotations

from ..functions.overlay import Thresholds
from ..functions.responses import EMPTY_BELOW, MARKERS, SMALL_BELOW
from ..functions.text import ACCENTED, PLAIN
from ..operators.enrich import EVIDENCE
from .marts import LATEST, ORACLES


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _fold(column: str) -> str:
    return f"lower(translate({column}, {_literal(ACCENTED)}, {_literal(PLAIN)}))"


def _overlay(t: Thresholds, name: str) -> str:
    """A table expression over signals (event_id, pol, vel, vol, eng): label, confidence, risk_score, n_factors."""
    return f"""{name}_flags AS (SELECT *, pol <= {t.polarity_negative} AND vel >= {t.velocity_spike} AND (vol >= {t.volume_spike} OR eng >= {t.engagement_high}) AS alert, pol <= {t.polarity_warning} AND (vel >= {t.velocity_warning} OR vol >= {t.volume_warning}) AS warning,
      pol >= {t.polarity_positive} OR (pol >= {t.polarity_warning} AND eng >= {t.engagement_high}) AS favorable, (vel >= {t.velocity_warning})::INT AS fast, (vol >= {t.volume_warning})::INT AS busy, (eng >= {t.engagement_high})::INT AS loud FROM signals),
    {name}_weights AS (SELECT *, CASE WHEN alert THEN 1.0 WHEN warning THEN 0.5 + 0.3 * fast + 0.2 * busy WHEN favorable THEN 0.6 + 0.4 * loud ELSE 1.0 END::DOUBLE AS weight, CASE WHEN alert THEN 3 WHEN warning THEN 1 + fast + busy WHEN favorable THEN 1 + loud ELSE 1 END AS n_factors,
      CASE WHEN alert THEN 'ALERT' WHEN warning THEN 'WARNING' WHEN favorable THEN 'FAVORABLE' ELSE 'WARNING' END AS raw FROM {name}_flags),
    {name}_scores AS (SELECT *, least(greatest(0.55::DOUBLE / (1 + exp(-3.0 * (weight - 0.9))) + 0.45::DOUBLE * (0.45::DOUBLE * least(abs(pol), 1) + 0.35::DOUBLE * least(greatest(vel, 0), 1) + 0.20::DOUBLE * reach), 0), 1) AS conf FROM {name}_weights),
    {name} AS (SELECT event_id, CASE WHEN (raw = 'FAVORABLE' AND conf < {t.min_confidence_favorable}) OR (raw = 'ALERT' AND conf < {t.min_confidence_alert}) THEN 'WARNING' ELSE raw END AS label, round(conf, 4) AS confidence,
      round(least(0.5::DOUBLE * greatest(-pol, 0) + 0.3::DOUBLE * greatest(vel, 0) + 0.2::DOUBLE * reach, 1), 4) AS risk_score, n_factors FROM {name}_scores)"""


_SIGNALS = f"""WITH {LATEST}, r AS (SELECT user_id, COUNT(*) AS vol, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0::DOUBLE AS span FROM ev GROUP BY 1),
    s AS (SELECT user_id, vol, CASE WHEN vol < 2 THEN 0.1 WHEN span <= 0 THEN 0.5 ELSE least(1.0, vol / span / 5) END::DOUBLE AS vel FROM r),
    signals AS (SELECT event_id, (250 - value) / 250 AS pol, vel, vol, trunc(value * 20) AS eng, least(ln(1 + greatest(trunc(value * 20), 0)) / ln(50001.0::DOUBLE), 1.0) AS reach FROM ev JOIN s USING (user_id))"""

ORACLES["political_overlay"] = f"{_SIGNALS}, {_overlay(Thresholds(), 'o')} SELECT *, '{Thresholds().version()}' AS rule_version FROM o"
ORACLES["overlay_shadow"] = (
    f"{_SIGNALS}, {_overlay(Thresholds(), 'o')}, {_overlay(Thresholds(polarity_negative=-0.5, velocity_spike=0.6), 'p')} SELECT o.label AS primary_label, p.label AS shadow_label, COUNT(*) AS n FROM o JOIN p USING (event_id) GROUP BY 1, 2"
)


def _blocked() -> str:
    found = {kind: "(" + " OR ".join(f"contains(body, {_literal(m)})" for m in markers) + ")" for kind, markers in MARKERS.items()}
    return f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 403 ELSE 200 END AS status, lower(coalesce(html, '')) AS body, strlen(coalesce(html, '')) AS size FROM pages),
    m AS (SELECT page_id, status, size, {", ".join(f"{sql} AS {kind}" for kind, sql in found.items())} FROM p),
    s AS (SELECT *, {" OR ".join(found)} AS marked, status IN (403, 429, 503) AND size < {SMALL_BELOW} AND NOT ({" OR ".join(found)}) AS refused FROM m)
    SELECT page_id, cloudflare, captcha, js_challenge, waf OR refused AS waf, size = 0 AS empty_body, size > 0 AND size < {EMPTY_BELOW} AS truncated_body, marked OR refused AS blocked,
      CASE WHEN marked OR refused THEN 'blocked_bot' WHEN status >= 400 THEN 'http_' || status WHEN size = 0 THEN 'empty_content' ELSE 'unknown' END AS failure FROM s"""


ORACLES["blocked_pages"] = _blocked()

ORACLES["centroid_roles"] = """WITH v AS (SELECT label, vec_id, embedding::DOUBLE[] AS x FROM embeddings), u AS (SELECT label, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM v), a AS (SELECT label, i, avg(e) AS e FROM u GROUP BY 1, 2),
    m AS (SELECT label, list(e ORDER BY i) AS mean FROM a GROUP BY 1), d AS (SELECT label, vec_id, round(greatest(0.0, least(2.0, 1 - list_dot_product(x, mean) / (sqrt(list_dot_product(x, x)) * sqrt(list_dot_product(mean, mean))))), 6) AS distance_to_centroid FROM v JOIN m USING (label))
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY distance_to_centroid, vec_id) = 1 THEN 'centroid' ELSE 'member' END AS member_role FROM d"""

ORACLES["resolved_people"] = f"""WITH p AS (SELECT c_custkey AS person_id, lower('c' || c_custkey) AS handle, {_fold("c_name")} AS name, {_fold("c_mktsegment")} AS city FROM customer),
    m AS (SELECT c_custkey AS mention_id, CASE WHEN c_custkey % 3 = 0 THEN lower('C' || c_custkey) END AS handle, {_fold("c_name")} AS name, {_fold("c_mktsegment")} AS context FROM customer),
    mt AS (SELECT DISTINCT * FROM (SELECT mention_id, context, unnest(regexp_split_to_array(name, '\\s+')) AS t FROM m) WHERE length(t) >= 3), pt AS (SELECT DISTINCT * FROM (SELECT person_id, city, unnest(regexp_split_to_array(name, '\\s+')) AS t FROM p) WHERE length(t) >= 3),
    x AS (SELECT mention_id, person_id, 1.0::DOUBLE AS c FROM m JOIN p USING (handle) UNION ALL SELECT mention_id, person_id, CASE WHEN context = '' THEN 0.90 WHEN city <> '' AND contains(context, city) THEN 0.90 ELSE 0.55 END FROM m JOIN p USING (name) UNION ALL SELECT mention_id, person_id, 0.50 + CASE WHEN city <> '' AND contains(context, city) THEN 0.20 ELSE 0 END FROM mt JOIN pt USING (t)),
    b AS (SELECT mention_id, person_id, max(c) AS c FROM x GROUP BY 1, 2), w AS (SELECT *, row_number() OVER o AS k, lead(c) OVER o AS next FROM b WINDOW o AS (PARTITION BY mention_id ORDER BY c DESC, person_id))
    SELECT m.mention_id, w.person_id, coalesce(w.c, 0.0)::DOUBLE AS confidence, CASE WHEN w.person_id IS NULL THEN 'OUT_OF_SCOPE' WHEN w.c >= 0.70 AND NOT coalesce(w.c - next < 0.15, FALSE) THEN 'IN_SCOPE' WHEN w.c >= 0.40 THEN 'AMBIGUOUS' ELSE 'OUT_OF_SCOPE' END AS status
    FROM m LEFT JOIN w ON w.mention_id = m.mention_id AND w.k = 1"""

_H, _N, _D, _B = EVIDENCE
ORACLES["resolution_scores"] = f"""WITH c AS (SELECT c_custkey, c_custkey % 5 = 0 AS handle, list_distinct(list_filter(regexp_split_to_array({_fold("concat_ws(' ', c_name, c_mktsegment)")}, '[^a-z0-9]+'), lambda t: length(t) > 1)) AS have, list_distinct(list_filter(regexp_split_to_array({_fold("c_name")}, '[^a-z0-9]+'), lambda t: length(t) > 1)) AS want,
      {_fold("concat_ws(' ', c_name, c_mktsegment)")} = {_fold("c_name")} AS same FROM customer), r AS (SELECT *, len(list_intersect(have, want)) / greatest(len(want), 1)::DOUBLE AS recall FROM c)
    SELECT c_custkey, round(least(greatest({_H} * handle::INT + {_N} * recall + {_D} * CASE WHEN handle OR same THEN 1.0 WHEN recall >= 0.5 THEN 0.5 ELSE 0.0 END, 0), 1), 4)::DOUBLE AS confidence FROM r"""

_PHRASES = (("general public license", "gpl", "license"), ("mit license", "mit", "license"), ("apache license", "apache", "license"), ("all rights reserved", "reserved", "notice"))
ORACLES["gazetteer_mentions"] = f"""WITH w AS (SELECT doc_id, regexp_extract_all({_fold("text")}, '[\\p{{L}}\\p{{N}}]+') AS w FROM documents), p AS (SELECT doc_id, w, unnest(range(0, len(w))) AS pos FROM w),
    n AS (SELECT * FROM (VALUES {", ".join(f"('{g}', '{e}', '{k}', {len(g.split())})" for g, e, k in _PHRASES)}) v(gram, entity, kind, size)), h AS (SELECT DISTINCT doc_id, pos, entity, kind FROM p JOIN n ON split_part(gram, ' ', 1) = w[pos + 1] AND array_to_string(w[pos + 1 : pos + size], ' ') = gram)
    SELECT doc_id, entity, kind, min(pos)::INT AS first_at, COUNT(*) AS n FROM h GROUP BY 1, 2, 3"""

ORACLES["personas"] = """WITH a AS (SELECT 'c' || c_custkey AS author_key, 'customer' AS platform, regexp_replace(lower(c_name), '[^a-z0-9]', '_', 'g') AS handle, lower(c_name) AS name FROM customer
      UNION ALL SELECT 's' || s_suppkey, 'supplier', regexp_replace(lower(replace(s_name, 'Supplier', 'Customer')), '[^a-z0-9]', '_', 'g'), lower(s_name) FROM supplier),
    b AS (SELECT DISTINCT author_key, platform, handle, name, unnest(['h:' || left(handle, 4), 'n:' || left(name, 5), 's:' || regexp_replace(handle, '[^a-z]', '', 'g')]) AS key FROM a),
    d AS (SELECT DISTINCT l.author_key AS x, r.author_key AS y, l.handle AS lh, r.handle AS rh, l.name AS ln, r.name AS rn FROM b l JOIN b r USING (key) WHERE l.platform < r.platform),
    e AS (SELECT *, regexp_replace(lh, '\\d+$', '') = regexp_replace(rh, '\\d+$', '') AND regexp_extract(lh, '(\\d+)$', 1) <> regexp_extract(rh, '(\\d+)$', 1) AND regexp_extract(lh, '(\\d+)$', 1) <> '' AND regexp_extract(rh, '(\\d+)$', 1) <> '' AS enumerated FROM d),
    s AS (SELECT x, y, greatest(jaro_winkler_similarity(lh, rh), CASE WHEN jaro_winkler_similarity(ln, rn) >= 0.90 THEN jaro_winkler_similarity(ln, rn) ELSE 0 END) AS score FROM e WHERE NOT enumerated AND (jaro_winkler_similarity(lh, rh) >= 0.90 OR jaro_winkler_similarity(ln, rn) >= 0.90)),
    u AS (SELECT x AS a, y AS b FROM s UNION SELECT y, x FROM s), c AS (SELECT a AS id, least(a, min(b)) AS component FROM u GROUP BY 1), w AS (SELECT component, min(score) AS confidence FROM s JOIN c ON c.id = s.x GROUP BY 1)
    SELECT id AS author_key, left(sha1(component), 16) AS persona_id, confidence::DOUBLE AS confidence FROM c JOIN w USING (component)"""
