"""Plain-SQL statements of the registered queries (run by DuckDB as an oracle).

They are written independently of the Spark plans, in the most direct
join form: neighbour sets by joins and DISTINCT, totals by counting
distinct union members, the friends measure by the explicit two-hop set,
the sampling caps by ORDER BY ... LIMIT and the endpoint index by a
global ROW_NUMBER. Only the fixed hash and parameters are shared.
"""

from __future__ import annotations

from edgewise.functions.features import (
    FEATURE_COLUMNS, FEATURE_NAMES, NB_FEATURES, SVM_LR_FEATURES, derived_sql,
)
from edgewise.functions.hashing import (
    SEED_SPLIT, SEED_TEST, SEED_TRAIN, pair_hash_sql as H, poisson_copies_sql, threshold, wide_hash_sql as HW,
)
from edgewise.operators import sampling as S


def W(ctes: list[tuple[str, str]], final: str) -> str:
    seen, parts = set(), []
    for name, body in ctes:
        if name in seen:
            continue
        seen.add(name)
        parts.append(f"{name} AS {'MATERIALIZED ' if name.startswith('fs_') else ''}(\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + final


EV_RAW = ("SELECT CAST(user_id AS BIGINT) AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst "
          "FROM events WHERE user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL")
CP_RAW = ("SELECT CAST(o.o_custkey AS BIGINT) AS src, CAST(l.l_partkey AS BIGINT) AS dst "
          "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
          "WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL")


def base_graphs():
    return [("ev_raw", EV_RAW),
            ("ev", "SELECT DISTINCT src, dst FROM ev_raw WHERE src <> dst"),
            ("cp_raw", CP_RAW),
            ("cp", "SELECT DISTINCT src, dst FROM cp_raw WHERE src <> dst")]


def two_hop_ctes(e: str, p: str, seed: int):
    """One uniformly drawn end of a length-2 path per edge of CTE ``e``."""
    salt = H('dst', 'src', seed)
    return [
        (f"{p}nbi", f"SELECT src AS b, dst AS c, row_number() OVER (PARTITION BY src ORDER BY {salt}, dst) - 1 AS idx, "
                    f"count(*) OVER (PARTITION BY src) AS n FROM {e}"),
        (f"{p}drawn", f"SELECT s.src AS u, x.b, x.c, x.n, x.idx FROM {e} s JOIN {p}nbi x ON x.b = s.dst "
                      f"AND x.idx = {HW('s.src', 's.dst', seed)} % x.n"),
        (f"{p}two", f"SELECT DISTINCT u, v FROM (SELECT u, c AS v FROM {p}drawn WHERE c <> u UNION ALL "
                    f"SELECT d.u, x.c AS v FROM {p}drawn d JOIN {p}nbi x ON x.b = d.b AND x.idx = (d.idx + 1) % d.n "
                    f"WHERE d.c = d.u AND d.n > 1) t"),
    ]


def sample_ctes(seed: int, p: str):
    """Vertex sample, subgraph and labelled pairs of the cp graph; CTE names prefixed by p."""
    thr = threshold(S.VERTEX_FRACTION)
    return base_graphs() + [
        (f"{p}vs", f"SELECT id, h FROM (SELECT id, {H('id', 0, seed)} AS h FROM "
                   f"(SELECT src AS id FROM cp UNION SELECT dst FROM cp)) t WHERE h < {thr}"),
        (f"{p}sub", f"SELECT src, dst FROM cp WHERE src <> dst AND src IN (SELECT id FROM {p}vs) "
                    f"AND dst IN (SELECT id FROM {p}vs)"),
        # positives: Poisson copies, cap by hash
        (f"{p}pos0", f"SELECT src AS u, dst AS v, {H('src', 'dst', seed)} AS h FROM {p}sub"),
        (f"{p}pos1", f"SELECT u, v, h, {poisson_copies_sql('h', S.POSITIVE_RATE)} AS copies FROM {p}pos0"),
        (f"{p}pos", f"SELECT u, v, 'Y' AS label FROM {p}pos1 JOIN range(1, 20) r(copy) ON r.copy <= {p}pos1.copies "
                    f"ORDER BY h, u, v, copy LIMIT {S.CAP_POSITIVE}"),
        # hard negatives: one drawn continuation per edge, real edges left out
        *two_hop_ctes(f"{p}sub", p, seed),
        (f"{p}hard", f"SELECT u, v, 'N' AS label FROM {p}two WHERE NOT EXISTS (SELECT 1 FROM {p}sub s "
                     f"WHERE s.src = {p}two.u AND s.dst = {p}two.v) ORDER BY {H('u', 'v', seed)}, u, v "
                     f"LIMIT {S.CAP_HARD}"),
        # weighted easy negatives: global index over endpoint occurrences
        (f"{p}ep", f"SELECT src, dst, 0 AS tag, src AS vertex FROM {p}sub UNION ALL "
                   f"SELECT src, dst, 1 AS tag, dst AS vertex FROM {p}sub"),
        (f"{p}epi", f"SELECT row_number() OVER (ORDER BY {H('src', 'dst', 'tag')}, "
                    f"src, dst, tag) - 1 AS idx, vertex FROM {p}ep"),
        (f"{p}n1", f"SELECT count(*) AS len FROM {p}ep"),
        (f"{p}d1", f"SELECT i, {HW('i', 1, seed)} % len AS i1, {HW('i', 2, seed)} % len AS i2 "
                   f"FROM range(0, {S.DRAWS_EASY_WEIGHTED}) t(i), {p}n1 WHERE len > 0"),
        (f"{p}easy1", f"SELECT a.vertex AS u, b.vertex AS v, 'N' AS label FROM {p}d1 d "
                      f"JOIN {p}epi a ON a.idx = d.i1 JOIN {p}epi b ON b.idx = d.i2 WHERE d.i1 <> d.i2 "
                      f"ORDER BY d.i LIMIT {S.CAP_EASY_WEIGHTED}"),
        # uniform easy negatives over the vertex sample
        (f"{p}vi", f"SELECT row_number() OVER (ORDER BY h, id) - 1 AS idx, id AS vertex FROM {p}vs"),
        (f"{p}n2", f"SELECT count(*) AS len FROM {p}vs"),
        (f"{p}d2", f"SELECT i, {HW('i', 3, seed)} % len AS i1, {HW('i', 4, seed)} % len AS i2 "
                   f"FROM range(0, {S.DRAWS_EASY_UNIFORM}) t(i), {p}n2 WHERE len > 0"),
        (f"{p}easy2", f"SELECT a.vertex AS u, b.vertex AS v, 'N' AS label FROM {p}d2 d "
                      f"JOIN {p}vi a ON a.idx = d.i1 JOIN {p}vi b ON b.idx = d.i2 WHERE d.i1 <> d.i2 "
                      f"ORDER BY d.i LIMIT {S.CAP_EASY_UNIFORM}"),
        (f"{p}pairs", f"SELECT * FROM {p}easy1 UNION ALL SELECT * FROM {p}easy2 UNION ALL "
                      f"SELECT * FROM {p}hard UNION ALL SELECT * FROM {p}pos"),
    ]


TR = "tr_"
TE = "te_"


def train_ctes():
    return sample_ctes(SEED_TRAIN, TR)


def feature_ctes(e: str, pairs: str, p: str):
    """22 features in join form for pairs CTE ``pairs`` over simple edges CTE ``e``."""
    return [
        (f"{p}p", f"SELECT u, v, max(label) AS label FROM {pairs} WHERE u <> v GROUP BY u, v"),
        (f"{p}deg", f"SELECT id, sum(o) AS out_degree, sum(i) AS in_degree FROM (SELECT src AS id, 1 AS o, 0 AS i "
                    f"FROM {e} UNION ALL SELECT dst AS id, 0 AS o, 1 AS i FROM {e}) t GROUP BY id"),
        (f"{p}bi", f"SELECT a.src AS id, count(*) AS bi FROM {e} a JOIN {e} b ON a.src = b.dst AND a.dst = b.src "
                   f"GROUP BY a.src"),
        (f"{p}vs", f"SELECT d.id, CAST(d.out_degree + d.in_degree AS BIGINT) AS degree, "
                   f"CAST(d.in_degree AS BIGINT) AS in_degree, CAST(d.out_degree AS BIGINT) AS out_degree, "
                   f"CAST(coalesce(b.bi, 0) AS BIGINT) AS bi FROM {p}deg d LEFT JOIN {p}bi b ON d.id = b.id"),
        (f"{p}pd", f"SELECT q.u, q.v, q.label, su.degree AS u_degree, sv.degree AS v_degree, su.in_degree AS u_in, "
                   f"su.out_degree AS u_out, su.bi AS u_bi, sv.in_degree AS v_in, sv.out_degree AS v_out, "
                   f"sv.bi AS v_bi FROM {p}p q JOIN {p}vs su ON su.id = q.u JOIN {p}vs sv ON sv.id = q.v"),
        (f"{p}co", f"SELECT q.u, q.v, count(*) AS c FROM {p}pd q JOIN {e} a ON a.src = q.u "
                   f"JOIN {e} b ON b.src = q.v AND b.dst = a.dst GROUP BY q.u, q.v"),
        (f"{p}ci", f"SELECT q.u, q.v, count(*) AS c FROM {p}pd q JOIN {e} a ON a.dst = q.u "
                   f"JOIN {e} b ON b.dst = q.v AND b.src = a.src GROUP BY q.u, q.v"),
        (f"{p}tout", f"SELECT u, v, count(DISTINCT n) AS c FROM (SELECT q.u, q.v, a.dst AS n FROM {p}pd q "
                     f"JOIN {e} a ON a.src = q.u UNION ALL SELECT q.u, q.v, a.dst AS n FROM {p}pd q "
                     f"JOIN {e} a ON a.src = q.v) t GROUP BY u, v"),
        (f"{p}tin", f"SELECT u, v, count(DISTINCT n) AS c FROM (SELECT q.u, q.v, a.src AS n FROM {p}pd q "
                    f"JOIN {e} a ON a.dst = q.u UNION ALL SELECT q.u, q.v, a.src AS n FROM {p}pd q "
                    f"JOIN {e} a ON a.dst = q.v) t GROUP BY u, v"),
        (f"{p}nb", f"SELECT DISTINCT u, v, n FROM (SELECT q.u, q.v, a.dst AS n FROM {p}pd q JOIN {e} a "
                   f"ON a.src = q.u UNION ALL SELECT q.u, q.v, a.dst AS n FROM {p}pd q JOIN {e} a "
                   f"ON a.src = q.v) t"),
        (f"{p}two", f"SELECT DISTINCT x.u, x.v, a.dst AS m FROM {p}nb x JOIN {e} a ON a.src = x.n"),
        (f"{p}fm", f"SELECT x.u, x.v, count(*) AS c FROM {p}nb x JOIN {p}two t ON t.u = x.u AND t.v = x.v "
                   f"AND t.m = x.n WHERE x.n IN (SELECT src FROM {e}) GROUP BY x.u, x.v"),
        (f"{p}cnt", f"SELECT q.u, q.v, q.u_degree, q.v_degree, q.u_in, q.u_out, q.u_bi, q.v_in, q.v_out, q.v_bi, "
                    f"CAST(coalesce(ci.c, 0) AS BIGINT) AS common_in, CAST(coalesce(co.c, 0) AS BIGINT) AS common_out, "
                    f"CAST(coalesce(ti.c, 0) AS BIGINT) AS total_in, CAST(coalesce(tu.c, 0) AS BIGINT) AS total_out, "
                    f"CAST(coalesce(fm.c, 0) AS BIGINT) AS friends_measure, q.label FROM {p}pd q "
                    f"LEFT JOIN {p}co co ON co.u = q.u AND co.v = q.v LEFT JOIN {p}ci ci ON ci.u = q.u AND ci.v = q.v "
                    f"LEFT JOIN {p}tout tu ON tu.u = q.u AND tu.v = q.v LEFT JOIN {p}tin ti ON ti.u = q.u AND ti.v = q.v "
                    f"LEFT JOIN {p}fm fm ON fm.u = q.u AND fm.v = q.v"),
        (f"{p}feat", f"SELECT {', '.join(FEATURE_COLUMNS)} FROM (SELECT *, {derived_sql()} FROM {p}cnt) t"),
    ]


def bag_feature_ctes(e: str, pairs: str, p: str, own: bool = False):
    """22 features of all pairs, isolated ends too, over edge rows as they come (repeats, self-loops).

    With ``own`` each pair's edge u -> v is deleted from the graph, pair by pair.
    """
    def kept(a: str, q: str = "q") -> str:
        return f"NOT ({a}.src = {q}.u AND {a}.dst = {q}.v)" if own else "true"

    def ends(key: str, far: str) -> str:
        return " UNION ALL ".join(f"SELECT q.u, q.v, '{s}' AS s, a.{far} AS n FROM {p}p q JOIN {e} a ON a.{key} = q.{s} WHERE {kept('a')}"
                                  for s in "uv")

    def sides(rows: str, s: str, name: str):
        return f"(SELECT u, v, count(*) FILTER (s = 'u') AS u_{name}, count(*) FILTER (s = 'v') AS v_{name} FROM {rows} GROUP BY u, v) {s}"

    def per_pair(rows: str, s: str, name: str):
        return (f"(SELECT u, v, count(*) AS total_{name}, count(*) FILTER (c > 1) AS common_{name} FROM "
                f"(SELECT u, v, n, count(*) AS c FROM {rows} GROUP BY u, v, n) t GROUP BY u, v) {s}")

    joins = "".join(f" LEFT JOIN {x} ON {a}.u = q.u AND {a}.v = q.v" for a, x in (
        ("o", sides(f"{p}o", "o", "out")), ("i", sides(f"{p}i", "i", "in")), ("b", sides(f"{p}b", "b", "bi")),
        ("co", per_pair(f"{p}o", "co", "out")), ("ci", per_pair(f"{p}i", "ci", "in")), ("f", f"{p}f f")))
    names = ("u_in", "u_out", "u_bi", "v_in", "v_out", "v_bi", "common_in", "common_out", "total_in", "total_out", "friends_measure")
    return [
        (f"{p}p", f"SELECT u, v, max(label) AS label FROM {pairs} WHERE u <> v GROUP BY u, v"),
        (f"{p}e", f"SELECT DISTINCT src, dst FROM {e}"),
        (f"{p}o", ends("src", "dst")),
        (f"{p}i", ends("dst", "src")),
        (f"{p}b", f"SELECT q.u, q.v, q.s FROM {p}o q JOIN {e} a ON a.src = q.n AND a.dst = CASE WHEN q.s = 'u' THEN q.u ELSE q.v END "
                  f"WHERE {kept('a')}"),
        (f"{p}nb", f"SELECT DISTINCT u, v, n FROM {p}o"),
        (f"{p}hop", f"SELECT q.u, q.v, q.n, a.dst AS m FROM {p}nb q JOIN {p}e a ON a.src = q.n WHERE {kept('a')}"),
        (f"{p}f", f"SELECT q.u, q.v, count(*) AS friends_measure FROM {p}nb q "
                  f"SEMI JOIN (SELECT DISTINCT u, v, m FROM {p}hop) t ON t.u = q.u AND t.v = q.v AND t.m = q.n "
                  f"SEMI JOIN (SELECT DISTINCT u, v, n FROM {p}hop) l ON l.u = q.u AND l.v = q.v AND l.n = q.n GROUP BY q.u, q.v"),
        (f"{p}cnt", f"SELECT q.u, q.v, label, {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in names)} FROM {p}p q{joins}"),
        (f"{p}feat", f"SELECT {', '.join(FEATURE_COLUMNS)} FROM (SELECT *, {derived_sql()} FROM "
                     f"(SELECT *, u_in + u_out AS u_degree, v_in + v_out AS v_degree FROM {p}cnt) t) t"),
    ]


def train_features():
    return train_ctes() + feature_ctes(f"{TR}sub", f"{TR}pairs", "ftr_")


def split_ctes():
    return train_features() + [
        ("spl", f"SELECT *, CASE WHEN {H('u', 'v', SEED_SPLIT)} < {threshold(0.6)} THEN 0 "
                f"WHEN {H('u', 'v', SEED_SPLIT)} < {threshold(0.8)} THEN 1 ELSE 2 END AS split FROM ftr_feat"),
    ]


LABEL_VALUE = "CASE WHEN label = 'Y' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"


def auc_sql(scored: str) -> list[tuple[str, str]]:
    return [
        ("sg", f"SELECT score, count(*) FILTER (WHERE label = 1.0) AS pos, "
               f"count(*) FILTER (WHERE label <> 1.0) AS neg FROM {scored} GROUP BY score"),
        ("sp", "SELECT score, pos, neg, coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
               "AND 1 PRECEDING), 0) AS pos_below, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN "
               "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM sg"),
    ]


def _heuristic_sql() -> str:
    """Every step until no feature gains 1e-6; the sums run in the order of adoption."""
    n = len(FEATURE_NAMES)
    values = " UNION ALL ".join(f"SELECT u, v, {i} AS cand, CAST({c} AS DOUBLE) AS x, lv FROM fs_val"
                                for i, c in enumerate(FEATURE_NAMES))
    ctes = split_ctes() + [
        ("fs_val", f"SELECT *, {LABEL_VALUE} AS lv FROM spl WHERE split = 1"), ("fs_x", values),
        ("fs_base0", "SELECT u, v, CAST(0.0 AS DOUBLE) AS b FROM fs_val")]
    final = []
    for k in range(n):
        out = " UNION ALL ".join(f"SELECT cand FROM fs_b{j}" for j in range(k))
        before = f"coalesce((SELECT auc FROM fs_b{k - 1}), 0.0)" if k else "0.0"
        where = f"WHERE EXISTS (SELECT 1 FROM fs_b{k - 1}) AND x.cand NOT IN ({out})" if k else ""
        ctes += [
            (f"fs_g{k}", f"SELECT x.cand, b.b + x.x AS score, count(*) FILTER (WHERE lv = 1.0) AS pos, "
                         f"count(*) FILTER (WHERE lv <> 1.0) AS neg FROM fs_x x JOIN fs_base{k} b USING (u, v) {where} "
                         f"GROUP BY x.cand, score"),
            (f"fs_w{k}", f"SELECT cand, score, pos, neg, coalesce(sum(neg) OVER (PARTITION BY cand ORDER BY score "
                         f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM fs_g{k}"),
            (f"fs_a{k}", f"SELECT cand, CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / "
                         f"(2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM fs_w{k} GROUP BY cand"),
            (f"fs_b{k}", f"SELECT cand, auc FROM fs_a{k} WHERE coalesce(auc, 0.0) - {before} >= 1e-6 "
                         f"ORDER BY auc DESC, cand LIMIT 1"),
            (f"fs_base{k + 1}", f"SELECT u, v, b + x AS b FROM fs_base{k} JOIN fs_x USING (u, v) "
                                f"WHERE cand IN (SELECT cand FROM fs_b{k})")]
        final.append(f"SELECT CAST({k} AS INTEGER) AS step, CAST(cand AS INTEGER) AS cand, auc, "
                     f"cand IN (SELECT cand FROM fs_b{k}) AS chosen FROM fs_a{k}")
    return W(ctes, " UNION ALL ".join(final))


def _bayes_selection_sql() -> str:
    """Forward selection with naive Bayes from class sums: every step to the stop, then the adopted set on the test rows."""
    n = len(FEATURE_NAMES)
    values = " UNION ALL ".join(f"SELECT split, u, v, {i} AS cand, '{c}' AS name, CAST({c} AS DOUBLE) AS x, {LABEL_VALUE} AS lv FROM spl"
                                for i, c in enumerate(FEATURE_NAMES))

    def nine(x: str) -> str:
        return f"floor(({x}) * 1e9 + 0.5) / 1e9"

    def weight(k: int, j: int, a: str) -> str:
        """Weight of the j-th adopted feature (the candidate itself for j = k) in a set of k + 1."""
        total = f"ln({a}.t1 + {k + 1}) - ln({a}.t0 + {k + 1})"
        return nine(f"(ln({a}.y{j} + CAST(1.0 AS DOUBLE)) - ln({a}.n{j} + CAST(1.0 AS DOUBLE))) - ({total})")

    ctes = split_ctes() + [
        ("fs_x", values),
        ("fs_s", "SELECT cand, name, coalesce(sum(x) FILTER (lv <> 1.0), 0.0) AS no, coalesce(sum(x) FILTER (lv = 1.0), 0.0) AS yes "
                 "FROM fs_x WHERE split = 0 GROUP BY cand, name"),
        ("fs_p", f"SELECT {nine('ln(count(*) FILTER (label = %s) + CAST(1.0 AS DOUBLE)) - ln(count(*) FILTER (label <> %s) + CAST(1.0 AS DOUBLE))' % (chr(39) + 'Y' + chr(39), chr(39) + 'Y' + chr(39)))} "
                 "AS p FROM spl WHERE split = 0"),
        ("fs_set0", "SELECT '' AS tried, '' AS names, 0 AS steps, CAST(0.0 AS DOUBLE) AS auc, CAST(0.0 AS DOUBLE) AS t0, "
                    "CAST(0.0 AS DOUBLE) AS t1"),
        ("fs_r0", "SELECT split, u, v, lv FROM fs_x WHERE cand = 0")]
    final, ends = [], []
    for k in range(n):
        out = " UNION ALL ".join(f"SELECT cand FROM fs_b{j}" for j in range(k)) or "SELECT -1"
        kept = "".join(f", s.y{j}, s.n{j}" for j in range(k))
        adopted = "".join(f", a{j}" for j in range(k))
        terms = "".join(f" + r.a{j} * c.w{j}" for j in range(k)) + f" + x.x * c.w{k}"
        weights = ", ".join(f"{weight(k, j, 'c')} AS w{j}" for j in range(k + 1))
        auc = "CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))"

        def aucs(name: str, split: int, cands: str, k=k, terms=terms, auc=auc):
            return [
                (f"{name}g", f"SELECT x.cand, (SELECT p FROM fs_p){terms} AS score, count(*) FILTER (r.lv = 1.0) AS pos, "
                             f"count(*) FILTER (r.lv <> 1.0) AS neg FROM fs_r{k} r JOIN fs_x x USING (u, v) JOIN {cands} c ON c.cand = x.cand "
                             f"WHERE r.split = {split} GROUP BY x.cand, score"),
                (f"{name}w", f"SELECT *, coalesce(sum(neg) OVER (PARTITION BY cand ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
                             f"AND 1 PRECEDING), 0) AS neg_below FROM {name}g"),
                (name, f"SELECT cand, {auc} AS auc FROM {name}w GROUP BY cand")]

        ctes += [
            (f"fs_c{k}", f"SELECT *, {weights} FROM (SELECT f.cand, f.name, s.tried, s.names, s.auc AS before, s.t0 + f.no AS t0, "
                         f"s.t1 + f.yes AS t1{kept}, f.yes AS y{k}, f.no AS n{k} FROM fs_set{k} s, fs_s f WHERE f.cand NOT IN ({out})) c"),
            *aucs(f"fs_a{k}", 1, f"fs_c{k}"),
            (f"fs_b{k}", f"SELECT c.*, a.auc FROM fs_c{k} c JOIN fs_a{k} a USING (cand) WHERE coalesce(a.auc, 0.0) - c.before >= 1e-6 "
                         f"ORDER BY a.auc DESC, cand LIMIT 1"),
            (f"fs_set{k + 1}", f"SELECT concat(tried, CASE WHEN tried = '' THEN '' ELSE ',' END, cand) AS tried, concat(names, CASE WHEN names = '' "
                               f"THEN '' ELSE ',' END, name) AS names, {k + 1} AS steps, auc, t0, t1"
                               + "".join(f", y{j}, n{j}" for j in range(k + 1)) + f" FROM fs_b{k}"),
            (f"fs_r{k + 1}", f"SELECT r.split, u, v, r.lv{adopted}, x.x AS a{k} FROM fs_r{k} r JOIN fs_x x USING (u, v) "
                             f"WHERE x.cand IN (SELECT cand FROM fs_b{k})"),
            *aucs(f"fs_t{k}", 2, f"fs_b{k}")]
        sep = "concat(c.{0}, CASE WHEN c.{0} = '' THEN '' ELSE ',' END, c.{1})"
        final.append(f"SELECT CAST({k} AS INTEGER) AS step, {sep.format('tried', 'cand')} AS tried, {sep.format('names', 'name')} AS names, "
                     f"coalesce(a.auc, 0.0) AS auc, c.cand IN (SELECT cand FROM fs_b{k}) AS chosen, 'validation' AS split "
                     f"FROM fs_c{k} c LEFT JOIN fs_a{k} a USING (cand)")
        last = f" WHERE NOT EXISTS (SELECT 1 FROM fs_b{k + 1})" if k + 1 < n else ""
        ends.append(f"SELECT CAST({k + 1} AS INTEGER) AS step, s.tried, s.names, coalesce(t.auc, 0.0) AS auc, true AS chosen, 'test' AS split "
                    f"FROM fs_set{k + 1} s, fs_t{k} t{last}")
    return W(ctes, " UNION ALL ".join(final + ends))


def _naive_bayes_sql() -> str:
    """Multinomial naive Bayes with add-one smoothing in closed form: the 0/1 prediction of every test row."""
    cols = [FEATURE_NAMES[i] for i in NB_FEATURES]
    k = len(cols)
    sums = ", ".join(f"sum(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(cols))
    total = " + ".join(f"s{i}" for i in range(k))
    theta = ", ".join(f"ln(s{i} + 1.0) - ln({total} + {float(k)}) AS t{i}" for i in range(k))
    margin = " + ".join(f"CAST(x.{c} AS DOUBLE) * (b.t{i} - a.t{i})" for i, c in enumerate(cols))
    ctes = split_ctes() + [
        ("nb_s", f"SELECT {LABEL_VALUE} AS y, count(*) AS n, {sums} FROM spl WHERE split = 0 GROUP BY y"),
        ("nb_t", f"SELECT y, ln(n + 1.0) AS p, {theta} FROM nb_s")]
    return W(ctes, f"SELECT x.u, x.v, CASE WHEN b.p - a.p + {margin} > 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END "
                   f"AS score, {LABEL_VALUE} AS label FROM spl x JOIN nb_t a ON a.y = 0.0 JOIN nb_t b ON b.y = 1.0 "
                   f"WHERE x.split = 2")


def _graph_q(final: str, extra=()) -> str:
    return W(base_graphs() + list(extra), final)


def _edge_features_sql() -> str:
    ctes = base_graphs() + [("evp", "SELECT src AS u, dst AS v, 'Y' AS label FROM ev")]
    ctes += feature_ctes("ev", "evp", "fev_")
    return W(ctes, "SELECT * FROM fev_feat")


def _test_features_sql() -> str:
    ctes = sample_ctes(SEED_TEST, TE) + feature_ctes(f"{TE}sub", f"{TE}pairs", "fte_")
    return W(ctes, "SELECT * FROM fte_feat")


def _scored_ctes():
    return split_ctes() + [("scored", f"SELECT jaccard_out AS score, {LABEL_VALUE} AS label FROM spl WHERE split = 2")]


_EDGE_LINES = """WITH e AS (SELECT event_id AS n, user_id, json_extract_string(props, '$.k') AS k FROM events),
l AS (SELECT *, CASE kind WHEN 'one' THEN CAST(user_id AS VARCHAR) WHEN 'word' THEN concat_ws(chr(9), user_id, 'x' || k)
             WHEN 'long' THEN concat_ws(' ', user_id, '99999999999999999999') WHEN 'more' THEN concat_ws(' ' || chr(9) || ' ', user_id, k, '1.5')
             ELSE concat_ws(chr(9), user_id, k) END AS line
      FROM (SELECT *, CASE WHEN n % 7 = 0 THEN 'one' WHEN n % 11 = 0 THEN 'word' WHEN n % 13 = 0 THEN 'comment' WHEN n % 17 = 0 THEN 'long'
                           WHEN n % 19 = 0 THEN 'blank' WHEN n % 23 = 0 THEN 'more' ELSE 'plain' END AS kind FROM e) t)
"""


_BASELINE = (f"SELECT a.u, a.v, CAST(a.c AS BIGINT) AS co_out, CAST(b.c AS BIGINT) AS co_in, p.label FROM zco a "
             f"JOIN zci b ON a.u = b.u AND a.v = b.v JOIN {TR}pairs p ON p.u = a.u AND p.v = a.v")


def _baseline_sql() -> str:
    return W(train_ctes() + _zero_pd(), _BASELINE)


def oracle_sql() -> dict[str, str]:
    tr = train_ctes()
    ft = train_features()
    fw = train_ctes() + feature_ctes("cp", f"{TR}pairs", "fw_")   # the pairs on the whole graph
    pv = "ftr_"
    q = {
        # graph core
        "graph_edges": _graph_q("SELECT src, dst FROM ev_raw"),
        "reverse_edges": _graph_q("SELECT dst AS src, src AS dst FROM ev"),
        "drop_self_loops": _graph_q("SELECT src, dst FROM ev_raw WHERE src <> dst"),
        "induced_subgraph": W(tr, f"SELECT src, dst FROM {TR}sub"),
        "vertex_degrees": _graph_q(
            "SELECT id, CAST(sum(o) + sum(i) AS BIGINT) AS degree, CAST(sum(i) AS BIGINT) AS in_degree, "
            "CAST(sum(o) AS BIGINT) AS out_degree FROM (SELECT src AS id, 1 AS o, 0 AS i FROM ev_raw "
            "UNION ALL SELECT dst AS id, 0 AS o, 1 AS i FROM ev_raw) t GROUP BY id"),
        "vertex_stats": W(base_graphs() + feature_ctes("cp", "cp_nopairs", "g_")[1:4],
                          "SELECT id, degree, in_degree, out_degree, bi FROM g_vs"),
        "graph_summary": W(tr, f"SELECT (SELECT count(*) FROM cp) AS edges, "
                               f"(SELECT count(*) FROM (SELECT src FROM cp UNION SELECT dst FROM cp) t) AS vertices, "
                               f"(SELECT count(*) FROM {TR}pairs) AS pairs"),
        "reciprocal_degree": _graph_q("SELECT a.src AS id, count(*) AS bi FROM cp a JOIN cp b "
                                      "ON a.src = b.dst AND a.dst = b.src GROUP BY a.src"),
        "edge_endpoint_degrees": _graph_q(
            "SELECT e.src, e.dst, s.d AS src_degree, t.d AS dst_degree FROM cp e "
            "JOIN deg s ON s.id = e.src JOIN deg t ON t.id = e.dst",
            [("deg", "SELECT id, CAST(count(*) AS BIGINT) AS d FROM (SELECT src AS id FROM cp "
                     "UNION ALL SELECT dst AS id FROM cp) t GROUP BY id")]),
        "property_graph_vertices": _graph_q(
            "SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, c_mktsegment AS role FROM customer "
            "UNION ALL SELECT id, 'John Doe' AS name, 'Missing' AS role FROM "
            "(SELECT src AS id FROM cp_raw UNION SELECT dst AS id FROM cp_raw) t "
            "WHERE id NOT IN (SELECT CAST(c_custkey AS BIGINT) FROM customer WHERE c_custkey IS NOT NULL)"),
        "vertex_predicate_count": _graph_q(
            "SELECT CAST(count(*) FILTER (WHERE role = 'BUILDING') AS BIGINT) AS n_vertices FROM ("
            "SELECT c_mktsegment AS role FROM customer UNION ALL SELECT 'Missing' AS role FROM "
            "(SELECT src AS id FROM cp_raw UNION SELECT dst AS id FROM cp_raw) t "
            "WHERE id NOT IN (SELECT CAST(c_custkey AS BIGINT) FROM customer WHERE c_custkey IS NOT NULL)) v"),
        "edge_predicate_count": (
            "SELECT CAST(count(*) FILTER (WHERE o.o_orderstatus = 'F') AS BIGINT) AS n_edges "
            "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
            "WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL"),
        # candidates
        "vertex_sample": W(tr, f"SELECT id FROM {TR}vs"),
        "two_hop_pairs": W(base_graphs() + _two_hop_full(), "SELECT u, v FROM full_two"),
        "positive_pairs": W(tr, f"SELECT * FROM {TR}pos"),
        "hard_negatives": W(tr, f"SELECT * FROM {TR}hard"),
        "easy_negatives_weighted": W(tr, f"SELECT * FROM {TR}easy1"),
        "easy_negatives_uniform": W(tr, f"SELECT * FROM {TR}easy2"),
        "non_edge_guard": W(base_graphs() + _two_hop_full(),
                            "SELECT u, v FROM full_two WHERE NOT EXISTS "
                            "(SELECT 1 FROM cp WHERE cp.src = full_two.u AND cp.dst = full_two.v)"),
        "sample_cap": _graph_q(f"SELECT src, dst FROM cp ORDER BY {H('src', 'dst', SEED_TRAIN)}, src, dst LIMIT 1000"),
        "labelled_pairs": W(tr, f"SELECT * FROM {TR}pairs"),
        "labelled_pairs_test": W(sample_ctes(SEED_TEST, TE), f"SELECT * FROM {TE}pairs"),
        "dedup_pairs": W(tr, f"SELECT u, v, max(label) AS label FROM {TR}pairs WHERE u <> v GROUP BY u, v"),
        "pairs_anti_join": W(tr + sample_ctes(SEED_TEST, TE),
                             f"SELECT * FROM {TR}pairs a WHERE NOT EXISTS (SELECT 1 FROM {TE}pairs b "
                             f"WHERE b.u = a.u AND b.v = a.v)"),
        "flatten_pairs": W(tr, f"SELECT u, v, label FROM {TR}pairs"),
        "train_val_test_split": W(tr, f"SELECT u, v, label, CASE WHEN {H('u', 'v', SEED_SPLIT)} < {threshold(0.6)} "
                                      f"THEN 0 WHEN {H('u', 'v', SEED_SPLIT)} < {threshold(0.8)} THEN 1 ELSE 2 END "
                                      f"AS split FROM (SELECT u, v, max(label) AS label FROM {TR}pairs "
                                      f"WHERE u <> v GROUP BY u, v) t"),
        # features
        "pair_degrees": W(fw, f"SELECT u, v, u_degree, v_degree, u_in, u_out, v_in, v_out, label FROM fw_pd"),
        "total_friends": W(train_ctes() + _zero_pd(), "SELECT z.u, z.v, CAST(coalesce(tu.c, 0) AS BIGINT) AS total_out, "
                                            "CAST(coalesce(ti.c, 0) AS BIGINT) AS total_in FROM zp z "
                                            "LEFT JOIN ztout tu ON tu.u = z.u AND tu.v = z.v "
                                            "LEFT JOIN ztin ti ON ti.u = z.u AND ti.v = z.v"),
        "common_friends": W(train_ctes() + _zero_pd(), "SELECT z.u, z.v, CAST(coalesce(co.c, 0) AS BIGINT) AS common_out, "
                                             "CAST(coalesce(ci.c, 0) AS BIGINT) AS common_in FROM zp z "
                                             "LEFT JOIN zco co ON co.u = z.u AND co.v = z.v "
                                             "LEFT JOIN zci ci ON ci.u = z.u AND ci.v = z.v"),
        "shared_neighbour_rows": W(train_ctes() + _zero_pd(), f"SELECT z.u, z.v, a.dst AS x FROM zp z JOIN cp a "
                                                    f"ON a.src = z.u JOIN cp b ON b.src = z.v AND b.dst = a.dst"),
        "friends_measure": W(train_ctes() + _zero_pd(), "SELECT z.u, z.v, CAST(coalesce(fm.c, 0) AS BIGINT) AS friends_measure "
                                              "FROM zp z LEFT JOIN zfm fm ON fm.u = z.u AND fm.v = z.v"),
        "densities": W(fw, f"SELECT u, v, u_in_density, u_out_density, u_bi_density, v_in_density, v_out_density, "
                           f"v_bi_density FROM fw_feat"),
        "pref_attachment": W(fw, f"SELECT u, v, pref_attachment FROM fw_feat"),
        "jaccard": W(fw, f"SELECT u, v, jaccard_in, jaccard_out FROM fw_feat"),
        "pair_features": W(ft, f"SELECT * FROM {pv}feat"),
        "pair_features_test": _test_features_sql(),
        "edge_features": _edge_features_sql(),
        "edge_features_multi": W(base_graphs() + [("evm", "SELECT DISTINCT src AS u, dst AS v, 'Y' AS label FROM ev_raw")]
                                 + bag_feature_ctes("ev_raw", "evm", "fem_"), "SELECT * FROM fem_feat"),
        "pair_features_excluded": W(tr + bag_feature_ctes(f"{TR}sub", f"{TR}pairs", "fx_", own=True), "SELECT * FROM fx_feat"),
        "edge_features_excluded": W(base_graphs() + [("evp", "SELECT src AS u, dst AS v, 'Y' AS label FROM ev")]
                                    + bag_feature_ctes("ev", "evp", "fex_", own=True), "SELECT * FROM fex_feat"),
        "label_encode": W(tr, f"SELECT u, v, label, {LABEL_VALUE} AS label_value FROM {TR}pairs"),
        "feature_subset": W(fw, f"SELECT u, v, {', '.join(FEATURE_NAMES[i] for i in SVM_LR_FEATURES)}, "
                                f"{LABEL_VALUE} AS label_value FROM fw_feat"),
        "feature_vectors": W(fw, f"SELECT u, v, {LABEL_VALUE} AS label_value, "
                                 f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in FEATURE_NAMES)}] AS features "
                                 f"FROM fw_feat"),
        "features_roundtrip": W(fw, f"SELECT * FROM fw_feat"),
        "edge_list_scan": _graph_q("SELECT src, dst FROM ev_raw"),
        "edge_rows_good": _EDGE_LINES + "SELECT CAST(user_id AS BIGINT) AS src, CAST(k AS BIGINT) AS dst FROM l "
                          "WHERE kind IN ('more', 'plain') AND user_id IS NOT NULL AND k IS NOT NULL",
        "edge_rows_bad": _EDGE_LINES + "SELECT line, CASE WHEN kind = 'one' OR user_id IS NULL OR (k IS NULL AND kind = 'plain') THEN 'fields' "
                         "ELSE 'id' END AS reason FROM l WHERE kind IN ('one', 'word', 'long') OR ((user_id IS NULL OR k IS NULL) "
                         "AND kind IN ('more', 'plain'))",
        "pair_rows_bad": W(tr, f"SELECT CASE WHEN u % 5 = 0 THEN concat_ws(',', u, v) WHEN u % 5 = 1 THEN concat_ws(',', u, 'v' || v, label) "
                               f"WHEN u % 5 = 2 THEN concat_ws(',', u, v, '?') ELSE concat_ws(',', u, v, label, '') END AS line, "
                               f"CASE u % 5 WHEN 0 THEN 'fields' WHEN 1 THEN 'id' WHEN 2 THEN 'label' ELSE 'fields' END AS reason "
                               f"FROM {TR}pairs WHERE u % 5 < 3 OR v % 3 = 0"),
        "ordered_pairs": W(tr, f"SELECT row_number() OVER (ORDER BY v, u) - 1 AS position, u, v, label FROM "
                               f"(SELECT u, v, max(label) AS label FROM {TR}pairs WHERE u <> v GROUP BY u, v) t"),
        "pairs_scan": W(tr, f"SELECT * FROM {TR}pairs"),
        # baseline
        "co_out_counts": W(train_ctes() + _zero_pd(), "SELECT u, v, CAST(c AS BIGINT) AS co_out FROM zco"),
        "co_in_counts": W(train_ctes() + _zero_pd(), "SELECT u, v, CAST(c AS BIGINT) AS co_in FROM zci"),
        "baseline_features": _baseline_sql(),
        # hand-over by manifest
        "published_edges": W(tr, f"SELECT src, dst FROM {TR}sub"),
        "published_pairs": W(tr, f"SELECT u, v, label FROM {TR}pairs"),
        "published_features": W(ft, f"SELECT * FROM {pv}feat"),
        "published_scores": W(_scored_ctes(), "SELECT score, label FROM scored"),
        "published_metrics": W(_scored_ctes() + auc_sql("scored") + [
            ("m", "SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / "
                  "(2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc, CAST(sum(pos) AS DOUBLE) AS positives, "
                  "CAST(sum(neg) AS DOUBLE) AS negatives FROM sp")],
            "SELECT 'jaccard_out' AS model, 'auc' AS metric, auc AS value FROM m UNION ALL "
            "SELECT 'jaccard_out', 'positives', positives FROM m UNION ALL SELECT 'jaccard_out', 'negatives', negatives FROM m"),
        "published_baseline": _baseline_sql(),
        "published_lines": W(
            ft + _zero_pd(), f"SELECT 'edges' AS output, count(*) AS lines FROM {TR}sub UNION ALL SELECT 'pairs', count(*) FROM {TR}pairs UNION ALL "
            f"SELECT 'features', count(*) FROM {pv}feat UNION ALL SELECT 'baseline', count(*) FROM ({_BASELINE}) t"),
        # evaluation
        "confusion_counts": W(split_ctes() + [
            ("sc", f"SELECT CASE WHEN common_out > 0 THEN 1.0 ELSE 0.0 END AS score, {LABEL_VALUE} AS label "
                   f"FROM spl WHERE split = 2"),
            ("cc", "SELECT CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 1.0) AS BIGINT) AS tp, "
                   "CAST(count(*) FILTER (WHERE score >= 0.5 AND label <> 1.0) AS BIGINT) AS fp, "
                   "CAST(count(*) FILTER (WHERE score < 0.5 AND label = 1.0) AS BIGINT) AS fn, "
                   "CAST(count(*) FILTER (WHERE score < 0.5 AND label <> 1.0) AS BIGINT) AS tn FROM sc")],
            "SELECT tp, fp, fn, tn, CASE WHEN 2 * (tp + fn) * (fp + tn) > 0 THEN "
            "CAST(2 * tp * tn + tp * fp + fn * tn AS DOUBLE) / CAST(2 * (tp + fn) * (fp + tn) AS DOUBLE) "
            "END AS hard_auc FROM cc"),
        "roc_curve": W(_scored_ctes() + auc_sql("scored") + [("tot", "SELECT sum(pos) AS P, sum(neg) AS N FROM sg")],
                       "SELECT score AS threshold, CAST(P - pos_below AS BIGINT) AS tp, CAST(N - neg_below AS BIGINT) AS fp, "
                       "CASE WHEN P > 0 THEN CAST(P - pos_below AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr, "
                       "CASE WHEN N > 0 THEN CAST(N - neg_below AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr "
                       "FROM sp, tot"),
        "auc_of_scores": W(_scored_ctes() + auc_sql("scored"),
                           "SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN "
                           "CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / "
                           "(2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc, "
                           "CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM sp"),
        "forward_selection_heuristic": _heuristic_sql(),
        "forward_selection": _bayes_selection_sql(),
        # models
        "nb_scores": _naive_bayes_sql(),
        "model_score_rows": W(split_ctes(), f"SELECT m.model, u, v, {LABEL_VALUE} AS label, true AS valid FROM spl, "
                              "(VALUES ('svm'), ('logreg'), ('nb'), ('rf'), ('gbt')) m(model) WHERE split = 2"),
        "model_confusion": W(split_ctes(), "SELECT m.model, CAST(count(*) FILTER (WHERE label = 'Y') AS BIGINT) AS positives, "
                             "CAST(count(*) FILTER (WHERE label <> 'Y') AS BIGINT) AS negatives, count(*) AS n_rows, "
                             "true AS chance_or_better FROM spl, (VALUES ('svm'), ('logreg'), ('nb'), ('rf'), ('gbt')) m(model) "
                             "WHERE split = 2 GROUP BY m.model"),
    }
    return q


def _two_hop_full():
    return two_hop_ctes("cp", "full_", SEED_TRAIN)


def _zero_pd():
    """Pair-level counts with isolated endpoints kept (zero degrees)."""
    e = "cp"
    return [
        ("zp", f"SELECT u, v, max(label) AS label FROM {TR}pairs WHERE u <> v GROUP BY u, v"),
        ("zco", f"SELECT q.u, q.v, count(*) AS c FROM zp q JOIN {e} a ON a.src = q.u "
                f"JOIN {e} b ON b.src = q.v AND b.dst = a.dst GROUP BY q.u, q.v"),
        ("zci", f"SELECT q.u, q.v, count(*) AS c FROM zp q JOIN {e} a ON a.dst = q.u "
                f"JOIN {e} b ON b.dst = q.v AND b.src = a.src GROUP BY q.u, q.v"),
        ("ztout", f"SELECT u, v, count(DISTINCT n) AS c FROM (SELECT q.u, q.v, a.dst AS n FROM zp q "
                  f"JOIN {e} a ON a.src = q.u UNION ALL SELECT q.u, q.v, a.dst AS n FROM zp q "
                  f"JOIN {e} a ON a.src = q.v) t GROUP BY u, v"),
        ("ztin", f"SELECT u, v, count(DISTINCT n) AS c FROM (SELECT q.u, q.v, a.src AS n FROM zp q "
                 f"JOIN {e} a ON a.dst = q.u UNION ALL SELECT q.u, q.v, a.src AS n FROM zp q "
                 f"JOIN {e} a ON a.dst = q.v) t GROUP BY u, v"),
        ("znb", f"SELECT DISTINCT u, v, n FROM (SELECT q.u, q.v, a.dst AS n FROM zp q JOIN {e} a "
                f"ON a.src = q.u UNION ALL SELECT q.u, q.v, a.dst AS n FROM zp q JOIN {e} a "
                f"ON a.src = q.v) t"),
        ("ztwo", f"SELECT DISTINCT x.u, x.v, a.dst AS m FROM znb x JOIN {e} a ON a.src = x.n"),
        ("zfm", f"SELECT x.u, x.v, count(*) AS c FROM znb x JOIN ztwo t ON t.u = x.u AND t.v = x.v "
                f"AND t.m = x.n WHERE x.n IN (SELECT src FROM {e}) GROUP BY x.u, x.v"),
    ]
