"""The registered queries in DuckDB SQL, step by step in the long form.

The SQL keeps every intermediate step, joins each account group separately and
ranks in the reports' own order, so it does not share the plan's shortcuts.
"""

from __future__ import annotations

import re

from gradeledger.checks.derived import CONFIG, TABLES, duckdb_table
from gradeledger.config import NEW, OLD, ReportConfig
from gradeledger.plans.risk import REPORT_R_COLUMNS, SHOWN, SHOWN_GROUPS
from gradeledger.sources.tables import METRICS

RATING_ORDER = (
    "sourcepopulateddate_rating DESC NULLS FIRST, versionid_ DESC NULLS FIRST, "
    "pkid_ DESC NULLS FIRST"
)
ENTITY_DATE = "sourcepopulateddate_entity DESC NULLS FIRST"
ENTITY_TIES = "cdicode ASC NULLS LAST, afm ASC NULLS LAST"
SCOPE = ("generation", "entityid", "statementid", "financialid")


def first_per(source: str, keys: str, order: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS rk FROM {source} WHERE {where}) WHERE rk = 1"
    )


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def listed(values) -> str:
    return ", ".join(str(v) for v in values)


def ratio(n: str, d: str, null_as_zero: bool = False) -> str:
    """Exact half-up division of two-digit decimals, in whole hundredths."""
    cents_n, cents_d = f"CAST(({n}) * 100 AS HUGEINT)", f"CAST(({d}) * 100 AS HUGEINT)"
    missing = f"{d} IS NULL OR " if null_as_zero else ""
    return (
        f"CASE WHEN {missing}{d} = 0 THEN CAST(0 AS DECIMAL(19,2)) ELSE "
        f"CAST(CAST(sign({cents_n}) * sign({cents_d}) * "
        f"((abs({cents_n}) * 1000 // abs({cents_d}) + 5) // 10) AS DECIMAL(19,0)) * 0.01 "
        f"AS DECIMAL(19,2)) END"
    )


def scaled(balance: str, code: str, factors) -> str:
    cases = " ".join(f"WHEN {code} = {k} THEN {balance} * {f}" for k, f in factors.items())
    return f"CAST(coalesce(CASE {cases} END, 0) AS DECIMAL(27,2))"


def zoned(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') || '+00'"


def ctes(cfg: ReportConfig) -> dict[str, str]:
    """Every step, as named queries."""
    bound = f"TIMESTAMP '{cfg.ref_date} 23:59:59'"
    live = f"TIMESTAMP '{cfg.go_live} 00:00:00'"
    portfolio = "TRUE" if cfg.portfolio is None else f"creditportfolio = '{cfg.portfolio}'"
    fin, pinned = quoted(cfg.financial_models), quoted(cfg.pinned)
    rating = (
        "approveid, approveddate, sourcepopulateddate_ AS sourcepopulateddate_rating, modelid, "
        "nextreviewdate, creditcommitteedate, islatestapprovedscenario, approvalstatus, "
        "financialcontext"
    )
    q: dict[str, str] = {name: duckdb_table(name) for name in TABLES}

    q["all_ratings"] = (
        "SELECT * REPLACE (CAST(entityid AS INT) AS entityid), 'new' AS generation "
        "FROM rating_new UNION ALL BY NAME SELECT *, CAST(NULL AS VARCHAR) AS "
        "entity_version_match, 'old' AS generation FROM rating_old"
    )
    q["elig_new"] = f"""SELECT pkid_, versionid_, CAST(entityid AS INT) AS entityid,
        CAST(entity_version_match AS INT) AS entityversion, {rating}, 'new' AS generation
        FROM rating_new WHERE approveddate >= {live} AND approveddate <= {bound}
        AND NOT isdeleted_ AND islatestapprovedscenario AND isprimary
        AND approvalstatus = '{cfg.approved_status}'"""
    q["elig_old"] = f"""SELECT pkid_, versionid_, entityid,
        CAST(regexp_extract(financialcontext, ';([^;#]*)#', 1) AS INT) AS entityversion,
        {rating}, 'old' AS generation FROM rating_old
        WHERE sourcepopulateddate_ >= {live} AND sourcepopulateddate_ <= {bound}
        AND NOT isdeleted_ AND isprimary AND regexp_matches(financialcontext, ';([^;#]*)#')"""
    q["elig"] = "SELECT * FROM elig_old UNION ALL SELECT * FROM elig_new"
    for g in (OLD, NEW):
        q[f"ent_{g}"] = f"""SELECT CAST(entityid AS INT) AS entityid, versionid_ AS ent_version,
            sourcepopulateddate_ AS sourcepopulateddate_entity, gc18 AS afm, cdicode,
            creditportfolio FROM entity_{g}"""
        q[f"pinned_{g}"] = f"""SELECT r.*, e.sourcepopulateddate_entity, e.afm, e.cdicode
            FROM elig_{g} r LEFT JOIN ent_{g} e ON r.entityid = e.entityid
            AND r.entityversion = e.ent_version AND e.sourcepopulateddate_entity <= {bound}
            WHERE e.sourcepopulateddate_entity IS NOT NULL AND {portfolio}"""
        q[f"pair_{g}"] = first_per(
            f"pinned_{g}", "entityid", f"{ENTITY_DATE}, {RATING_ORDER}, {ENTITY_TIES}",
            f"modelid IN ({pinned})",
        )
        owner = OLD if g == OLD else cfg.nonfin_entity_gen
        q[f"asof_pairs_{g}"] = f"""SELECT r.*, e.sourcepopulateddate_entity, e.afm, e.cdicode
            FROM elig_{g} r JOIN ent_{owner} e ON r.entityid = e.entityid
            AND e.sourcepopulateddate_entity < r.sourcepopulateddate_rating
            AND e.sourcepopulateddate_entity <= {bound}
            WHERE r.modelid NOT IN ({pinned}) AND {portfolio}"""
        q[f"asof_{g}"] = first_per(
            f"asof_pairs_{g}", "pkid_, entityid",
            f"{ENTITY_DATE}, sourcepopulateddate_rating DESC NULLS FIRST, "
            f"versionid_ DESC NULLS FIRST, {ENTITY_TIES}",
        )
        q[f"matched_{g}"] = (
            f"SELECT *, 'financials' AS match_kind FROM pair_{g} UNION ALL "
            f"SELECT *, 'non_financials' AS match_kind FROM asof_{g}"
        )
        q[f"graded_{g}"] = f"""SELECT m.*, f.finalgrade, d.ratingscalevalue,
            CASE WHEN d.ratingscalevalue IS NOT NULL THEN 'true' ELSE 'false' END AS graded
            FROM matched_{g} m LEFT JOIN entityrating_{g} f ON m.approveid = f.approveid
            LEFT JOIN ratingscale d ON f.finalgrade = d.ratingscalekey_"""
        q[f"r_pinned_{g}"] = f"""SELECT DISTINCT *, 'financials' AS match_kind FROM pinned_{g}
            WHERE modelid IN ({fin}) AND financialcontext NOT IN ('0', '', '###')
            AND length(financialcontext) > {cfg.min_context}"""
    q["ent_all"] = (
        "SELECT *, 'old' AS generation FROM ent_old UNION ALL "
        "SELECT *, 'new' AS generation FROM ent_new"
    )
    q["ratings_union"] = "SELECT * FROM graded_old UNION SELECT * FROM graded_new"
    q["final_p"] = first_per(
        "ratings_union", "entityid",
        "sourcepopulateddate_rating DESC NULLS FIRST, "
        "CASE generation WHEN 'old' THEN 0 ELSE 1 END, "
        "versionid_ DESC NULLS FIRST, pkid_ DESC NULLS FIRST, finalgrade DESC NULLS LAST, "
        "ratingscalevalue DESC NULLS LAST",
        "approveddate IS NOT NULL AND islatestapprovedscenario",
    )
    q["r_union"] = "SELECT * FROM r_pinned_old UNION SELECT * FROM r_pinned_new"
    q["final_r"] = first_per(
        "r_union", "entityid",
        f"sourcepopulateddate_rating DESC NULLS FIRST, {ENTITY_DATE}, "
        "CASE generation WHEN 'old' THEN 0 ELSE 1 END, versionid_ DESC NULLS FIRST, "
        f"pkid_ DESC NULLS FIRST, {ENTITY_TIES}",
        "approveddate IS NOT NULL AND islatestapprovedscenario",
    )
    for r in ("p", "r"):
        q[f"items_{r}"] = f"""SELECT f.*, item FROM final_{r} f,
            unnest(string_split(regexp_replace(financialcontext, '.*#([^:*]+)', '\\1'), ';'))
            AS u(item) WHERE modelid IN ({fin})"""
        q[f"perim_{r}"] = f"""SELECT * EXCLUDE (item),
            regexp_extract(item, '^(\\d+)', 1) AS statement_text,
            CAST(regexp_extract(item, '^(\\d+)', 1) AS INT) AS statementid,
            TRY_CAST(regexp_extract(financialcontext, '^[^:]*') AS INT) AS financialid
            FROM items_{r} WHERE regexp_matches(item, '^\\d+')"""

    header = "s.pkid_, s.versionid_ AS versionid_financial, s.statementyear, s.statementmonths, " \
        "s.statementdatekey_, s.sourcepopulateddate_ AS sourcepopulateddate_financial"
    metrics = ", ".join(METRICS)
    for r, extra in (("p", "per.match_kind = 'financials'"), ("r", "TRUE")):
        grade = "per.finalgrade, per.ratingscalevalue," if r == "p" else ""
        scope = f"""per.generation, per.entityid, per.financialid, per.statementid,
            per.statement_text, per.cdicode, per.afm, per.approveddate, per.nextreviewdate,
            per.creditcommitteedate, per.modelid, {grade} per.versionid_ AS versionid_rating,
            per.sourcepopulateddate_rating"""
        q[f"found_{r}_old"] = f"""SELECT {header}, {scope}, {metrics}
            FROM statement_old s JOIN perim_{r} per ON s.entityid = per.entityid
            AND s.financialid = per.financialid AND s.statementid = per.statementid
            JOIN statement_metrics_old m ON s.pkid_ = m.pkid_ AND s.versionid_ = m.versionid_
            WHERE per.generation = 'old' AND {extra}
            AND per.approvalstatus = '{cfg.approved_status}'"""
        q[f"found_{r}_new"] = f"""SELECT {header}, {scope}, {metrics}
            FROM statement_new s JOIN perim_{r} per ON CAST(s.entityid AS INT) = per.entityid
            AND CAST(s.financialid AS INT) = per.financialid
            AND CAST(s.statementid AS INT) = per.statementid
            WHERE per.generation = 'new' AND {extra}"""
        for g in (OLD, NEW):
            keep = "TRUE" if r == "p" else (
                f"statementmonths = {cfg.statement_months} AND approveddate >= {live} "
                f"AND approveddate <= {bound}"
            )
            q[f"chosen_{r}_{g}"] = _chosen(f"found_{r}_{g}", keep)
            year = "statement_text" if r == "p" else "statementid"
            rated = "" if r == "p" else "versionid_rating, "
            q[f"year_{r}_{g}"] = first_per(
                f"chosen_{r}_{g}", f"entityid, {rated}cdicode, afm, statementyear",
                "sourcepopulateddate_financial DESC NULLS FIRST, "
                f"{year} DESC NULLS FIRST, versionid_financial DESC NULLS FIRST, "
                "pkid_ DESC NULLS FIRST",
            )
        for step in ("found", "chosen", "year"):
            q[f"{step}_{r}"] = (
                f"SELECT * FROM {step}_{r}_old UNION ALL SELECT * FROM {step}_{r}_new"
            )
    q["strict_new"] = first_per(
        _as_table(_chosen(
            "found_p_new", "sourcepopulateddate_financial <= sourcepopulateddate_rating"
        )),
        "entityid, cdicode, afm, statementyear",
        "sourcepopulateddate_financial DESC NULLS FIRST, statement_text DESC NULLS FIRST, "
        "versionid_financial DESC NULLS FIRST, pkid_ DESC NULLS FIRST",
    )

    labels = f"""cdicode AS cdi, afm, ratingscalevalue AS grade, {zoned('approveddate')}
        AS approveddate, strftime(nextreviewdate, '%d-%m-%Y') AS nextreviewdate,
        modelid AS ratingmodelname, {{year}} AS fiscalyear, {{sales}} AS salesrevenues,
        {{assets}} AS totalassets, CAST(entityid AS VARCHAR) AS entityid,
        CASE WHEN finalgrade IS NOT NULL THEN 'true' ELSE 'false' END AS overrideflag,
        strftime(creditcommitteedate, '%d-%m-%Y') AS creditcommitteedate"""
    stated = labels.format(
        year="CAST(statementyear AS VARCHAR)", sales="CAST(salesrevenues AS VARCHAR)",
        assets="CAST(totalassets AS VARCHAR)",
    )
    null = "CAST(NULL AS VARCHAR)"
    q["p_years"] = f"SELECT {stated} FROM year_p"
    q["strict_years"] = f"SELECT {stated} FROM strict_new"
    q["canon_years"] = """SELECT *, CASE WHEN regexp_full_match(afm, '0+') THEN '00000000'
        ELSE afm END AS canon FROM p_years"""
    q["report_p"] = "SELECT * EXCLUDE (canon) FROM (" + first_per(
        "canon_years", "entityid, cdi, canon", "fiscalyear DESC NULLS FIRST"
    ) + ")"
    q["p_nonfin"] = f"""SELECT {labels.format(year=null, sales=null, assets=null)} FROM final_p
        WHERE modelid NOT IN ({fin}) AND match_kind = 'non_financials'
        AND (generation = 'new' OR approvalstatus = '{cfg.approved_status}')"""

    codes = cfg.account_codes
    q["bal_new"] = f"""SELECT CAST(statementid AS INT) AS statementid,
        CAST(financialid AS INT) AS financialid, CAST(accountid AS INT) AS accountid, versionid_,
        sourcepopulateddate_, CAST(originrounding AS DECIMAL(19,2)) AS originrounding,
        CAST(originbalance AS DECIMAL(19,2)) AS originbalance, id_ FROM balance_new
        WHERE accountid IN ({quoted(codes)})"""
    q["bal_old"] = f"SELECT * FROM balance_old WHERE accountid IN ({listed(codes)})"
    q["bal_all"] = (
        "SELECT *, 'old' AS generation FROM bal_old UNION ALL "
        "SELECT * EXCLUDE (id_), 'new' AS generation FROM bal_new"
    )
    booked = "per.generation, per.entityid, b.statementid, b.financialid, b.accountid, " \
        "b.versionid_, b.sourcepopulateddate_, b.originrounding, b.originbalance"
    join = "ON b.financialid = per.financialid AND b.statementid = per.statementid"
    q["macros_new_all"] = f"""SELECT {booked}, b.id_, per.sourcepopulateddate_rating
        FROM bal_new b JOIN perim_r per {join} WHERE per.generation = 'new'"""
    latest_balance = "sourcepopulateddate_ DESC NULLS FIRST, versionid_ DESC NULLS FIRST, " \
        "originbalance DESC NULLS FIRST, originrounding DESC NULLS FIRST"
    per_account = "entityid, financialid, statementid, accountid"
    q["macros_new"] = "SELECT * EXCLUDE (id_, sourcepopulateddate_rating) FROM (" + first_per(
        "macros_new_all", per_account, latest_balance
    ) + ")"
    q["macros_old"] = f"""SELECT DISTINCT {booked} FROM bal_old b JOIN perim_r per {join}
        WHERE per.generation = 'old' AND per.approveddate >= {live}
        AND per.approveddate <= {bound}"""
    q["macros_all"] = "SELECT * FROM macros_old UNION ALL SELECT * FROM macros_new"
    amount = scaled("originbalance", "originrounding", cfg.rounding_map)
    keys = ", ".join(SCOPE)
    for name, group in cfg.accounts.items():
        signed = amount
        minus = [-c for c in group if c < 0]
        if minus:
            signed = f"CASE WHEN accountid IN ({listed(minus)}) THEN -{amount} ELSE {amount} END"
        total = "max(amount)" if name == "goodwill" else "sum(amount)"
        q[f"ag_{name}"] = f"""SELECT {keys}, CAST({total} AS DECIMAL(37,2)) AS {name}
            FROM (SELECT DISTINCT {keys}, accountid, {signed} AS amount FROM macros_all
            WHERE accountid IN ({listed(abs(c) for c in group)})) GROUP BY {keys}"""
    group_joins = " ".join(
        f"LEFT JOIN ag_{g} USING ({keys})" for g in cfg.accounts
    )
    q["groups_wide"] = f"""SELECT {keys}, {', '.join(cfg.accounts)}
        FROM (SELECT DISTINCT {keys} FROM macros_all) {group_joins}"""

    q["capital_base"] = first_per(
        "found_r", "generation, pkid_",
        "sourcepopulateddate_financial DESC NULLS FIRST, approveddate DESC NULLS FIRST, "
        "versionid_financial DESC NULLS FIRST",
    )
    when = "statementdatekey_" if cfg.lag_order == "date" else "statementyear"
    q["capital_change"] = _capital_change("capital_base", when)
    dec = "CAST({} AS DECIMAL(19,2))"
    shown = {n: f"coalesce({dec.format(m)}, 0)" for n, m in (SHOWN | SHOWN_GROUPS).items()}
    made = shown | {
        "cdi": "cdicode", "afm": "afm", "profitbeforetax": "profitbeforetax",
        "chgcommonsharecapital_chgsharepremium":
            dec.format("chg_commonsharecapital + chg_sharepremium"),
        "totalbankingdebttoebitda": ratio(dec.format("total_debt"), "ebitda"),
        "netbankingdebttoebitda": ratio(
            f"coalesce({dec.format('total_debt')}, 0) - cashandequivalents", "ebitda"
        ),
        "interestcoverage": ratio("ebitda", dec.format("interest"), null_as_zero=True),
        "fnc_year": "CAST(statementyear AS VARCHAR)",
        "creditcommitteedate": "strftime(creditcommitteedate, '%d-%m-%Y')",
        "publish_date":
            "strftime(strptime(CAST(statementdatekey_ AS VARCHAR), '%Y%m%d'), '%Y%m%d')",
        "approveddate": zoned("approveddate"),
        "reference_date": f"'{cfg.ref_date:%Y%m%d}'",
        "entityid": "concat_ws('|', CAST(entityid AS VARCHAR), CAST(versionid_rating AS VARCHAR))",
    }
    made |= {n: dec.format(made[n]) for n in [*SHOWN, *SHOWN_GROUPS, "profitbeforetax"]}
    q["wide_r"] = f"""SELECT * FROM year_r {group_joins} LEFT JOIN (SELECT {keys},
        chg_commonsharecapital, chg_sharepremium FROM capital_change) USING ({keys})"""
    q["report_r"] = (
        "SELECT " + ", ".join(f"{made[c]} AS {c}" for c in REPORT_R_COLUMNS) + " FROM wide_r"
    )

    q["ranked_versions"] = first_per(
        "ratings_union", "entityid, pkid_, versionid_",
        "sourcepopulateddate_rating DESC NULLS FIRST, "
        "CASE generation WHEN 'old' THEN 0 ELSE 1 END",
        "approveddate IS NOT NULL AND islatestapprovedscenario",
    )
    q["earlier_balances"] = (
        "SELECT * FROM macros_new_all WHERE sourcepopulateddate_ < sourcepopulateddate_rating"
    )
    q["every_balance_new"] = f"""SELECT per.entityid, per.statementid, per.financialid,
        b.versionid_, CAST(b.accountid AS INT) AS accountid, b.sourcepopulateddate_
        FROM balance_new b JOIN perim_r per ON CAST(b.financialid AS INT) = per.financialid
        AND CAST(b.statementid AS INT) = per.statementid WHERE per.generation = 'new'
        AND b.sourcepopulateddate_ < per.sourcepopulateddate_rating"""
    q["pinned_version"] = first_per(
        "every_balance_new", "entityid, financialid, statementid",
        "sourcepopulateddate_ DESC NULLS FIRST, accountid ASC NULLS LAST, "
        "versionid_ DESC NULLS FIRST",
    )
    q["balance_pinned"] = """SELECT DISTINCT b.entityid, b.statementid, b.financialid,
        b.versionid_, b.accountid, b.sourcepopulateddate_, b.originrounding, b.originbalance
        FROM earlier_balances b JOIN pinned_version v ON b.entityid = v.entityid
        AND b.statementid = v.statementid AND b.financialid = v.financialid
        AND b.versionid_ = v.versionid_"""
    q["reviewed_balances"] = f"""SELECT per.generation, per.entityid, b.statementid,
        b.financialid, b.accountid, b.versionid_, b.sourcepopulateddate_, b.originrounding,
        b.originbalance FROM bal_new b
        JOIN (SELECT *, nullif(regexp_extract(item, ':(\\d+)', 1), '') AS statementid_version,
              CAST(nullif(regexp_extract(item, '^(\\d+)', 1), '') AS INT) AS statementid,
              TRY_CAST(regexp_extract(financialcontext, '^[^:]*') AS INT) AS financialid
              FROM items_r) per {join}
        JOIN historical_statement h ON CAST(h.financialid AS INT) = per.financialid
        AND CAST(h.statementid AS INT) = per.statementid
        AND h.versionid_ = CAST(per.statementid_version AS INT)
        AND h.dimhistoricalstatementid_ = b.id_
        WHERE per.generation = 'new' AND h.status = 'Reviewed'"""
    q["reviewed_only"] = first_per("reviewed_balances", per_account, latest_balance)

    rated = """SELECT DISTINCT generation, entityid, financialid, cdicode, afm, approveddate,
        approvalstatus, sourcepopulateddate_rating FROM perim_r"""
    seed_cols = """s.pkid_, s.versionid_ AS versionid_financial, s.statementyear,
        s.statementmonths, s.statementdatekey_,
        s.sourcepopulateddate_ AS sourcepopulateddate_financial, per.generation, per.entityid,
        CAST(s.statementid AS INT) AS statementid, per.financialid, per.cdicode, per.afm,
        per.approveddate, commonsharecapital, sharepremium"""
    q["known_statements"] = f"""SELECT {seed_cols} FROM statement_old s
        JOIN statement_metrics_old m ON s.pkid_ = m.pkid_ AND s.versionid_ = m.versionid_
        JOIN ({rated}) per ON s.entityid = per.entityid AND s.financialid = per.financialid
        AND s.sourcepopulateddate_ <= per.sourcepopulateddate_rating
        WHERE per.generation = 'old' AND per.approvalstatus = '{cfg.approved_status}'
        UNION ALL SELECT {seed_cols} FROM statement_new s JOIN ({rated}) per
        ON CAST(s.entityid AS INT) = per.entityid AND CAST(s.financialid AS INT) = per.financialid
        AND s.sourcepopulateddate_ <= per.sourcepopulateddate_rating
        WHERE per.generation = 'new'"""
    q["known_latest"] = first_per(
        "known_statements", "generation, pkid_",
        "sourcepopulateddate_financial DESC NULLS FIRST, approveddate DESC NULLS FIRST, "
        "versionid_financial DESC NULLS FIRST",
    )
    seed = ("pkid_, generation, entityid, statementid, financialid, cdicode, afm, "
            "statementyear, statementmonths, statementdatekey_, versionid_financial, "
            "sourcepopulateddate_financial, commonsharecapital, sharepremium")
    q["first_years"] = """SELECT entityid, cdicode, afm, min(statementyear) AS first_year
        FROM capital_base GROUP BY ALL"""
    q["seed_candidates"] = """SELECT k.* FROM known_latest k JOIN first_years y
        ON k.entityid = y.entityid AND k.cdicode = y.cdicode AND k.afm = y.afm AND k.statementyear = y.first_year - 1"""
    q["seeds"] = first_per(
        "seed_candidates", "entityid, cdicode, afm",
        "statementyear DESC NULLS FIRST, sourcepopulateddate_financial DESC NULLS FIRST, "
        "versionid_financial DESC NULLS FIRST, pkid_ DESC NULLS FIRST",
    )
    q["seeded_base"] = (
        f"SELECT {seed}, 'exclude_from_rating' AS seed_flag FROM seeds UNION ALL "
        f"SELECT {seed}, 'include_in_rating' AS seed_flag FROM capital_base"
    )
    q["seeded_change"] = _capital_change("seeded_base", "statementdatekey_")
    return q


def _as_table(sql: str) -> str:
    return f"({sql})"


def _chosen(source: str, keep: str) -> str:
    """Statement choice with one rank per class, as the reports word it."""
    order = "PARTITION BY pkid_ ORDER BY late, sourcepopulateddate_financial {}, " \
        "approveddate DESC NULLS FIRST, versionid_financial DESC NULLS FIRST"
    return f"""SELECT * EXCLUDE (late, pick) FROM (SELECT *, CASE WHEN late
        THEN row_number() OVER ({order.format('ASC NULLS LAST')})
        ELSE row_number() OVER ({order.format('DESC NULLS FIRST')}) END AS pick
        FROM (SELECT *, NOT coalesce(sourcepopulateddate_financial
        <= sourcepopulateddate_rating, FALSE) AS late FROM {source} WHERE {keep})) WHERE pick = 1"""


def _capital_change(source: str, when: str) -> str:
    over = f"OVER (PARTITION BY entityid, cdicode, afm, financialid ORDER BY {when} " \
        "ASC NULLS LAST, statementid ASC NULLS LAST, pkid_ ASC NULLS LAST)"
    return f"""SELECT *,
        CAST(commonsharecapital - prev_commonsharecapital AS DECIMAL(20,2))
        AS chg_commonsharecapital,
        CAST(sharepremium - prev_sharepremium AS DECIMAL(20,2)) AS chg_sharepremium
        FROM (SELECT *, lag(commonsharecapital, 1) {over} AS prev_commonsharecapital,
        lag(sharepremium, 1) {over} AS prev_sharepremium FROM {source})"""


def with_steps(body: str, cfg: ReportConfig = CONFIG) -> str:
    """The body behind the steps it needs, directly or through others."""
    steps = ctes(cfg)
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for word in set(re.findall(r"[a-z_]+[a-z0-9_]*", sql)):
            if word in steps and word not in needed:
                needed.add(word)
                visit(steps[word])

    visit(body)
    order = _sorted(steps, needed)
    return "WITH " + ", ".join(f"{n} AS ({steps[n]})" for n in order) + " " + body \
        if order else body


def _sorted(steps: dict[str, str], needed: set[str]) -> list[str]:
    """Steps so that each follows what it reads."""
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        for word in re.findall(r"[a-z_]+[a-z0-9_]*", steps[name]):
            if word in steps and word != name:
                place(word)
        done.append(name)

    for name in steps:
        if name in needed:
            place(name)
    return done
