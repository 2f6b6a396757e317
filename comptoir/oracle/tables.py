"""Every table of the three layers as a DuckDB common table expression.

Written independently of the Spark plans, but for the city lists, which are
fixed values and are taken from their one place; and in the plain form: sales are
joined row by row, pairs are counted by a raw self join, quantiles come from
the built-in. A statement for a table is ``statement(select)``: the select plus
the expressions it needs, found by name.
"""

from __future__ import annotations

import re

from comptoir.functions.geography import OTHER_REGION, REGION_CITIES
from comptoir.sources.retail_tables import city_slots


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def rounded(number: str, scale: int = 2) -> str:
    return f"CAST(round(CAST(CAST({number} AS DOUBLE) AS DECIMAL(28,6)), {scale}) AS DOUBLE)"


def amount(number: str) -> str:
    return f"CAST(round({number}, 2) AS DOUBLE)"


def mean(column: str, scale: int = 2) -> str:
    total = f"CAST(sum(CAST({column} AS DECIMAL(28,2))) AS DOUBLE)"
    return rounded(f"{total} / nullif(count({column}), 0)", scale)


def whole(number: str) -> str:
    return f"CAST({number} AS BIGINT)"


def initcap(string: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({string}), ' '),"
        " lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


def blank_as(column: str, default: str) -> str:
    return f"CASE WHEN {column} IS NULL OR trim({column}) = '' THEN {text(default)} ELSE {column} END"


def first_copy(table: str, keys: str, others: str, required: tuple[str, ...] = ()) -> str:
    """The copy that lacks the fewest required columns, then the smallest with nulls last."""
    lacking = [" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in required)] if required else []
    order = ", ".join([*lacking, *(f"{c.strip()} ASC NULLS LAST" for c in others.split(","))])
    return f"""
        SELECT * EXCLUDE (copy_no) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS copy_no FROM {table})
        WHERE copy_no = 1"""


def region_case(column: str) -> str:
    arms = " ".join(
        f"WHEN {column} IN ({', '.join(map(text, cities))}) THEN {text(region)}"
        for region, cities in REGION_CITIES.items()
    )
    return f"CASE {arms} ELSE {text(OTHER_REGION)} END"


MEASURES = f"""{amount('sum(montant)')} AS ca_total,
        count(vente_id) AS nb_ventes,
        {rounded('CAST(sum(montant) AS DOUBLE) / count(montant)')} AS panier_moyen,
        {whole('sum(quantite)')} AS total_quantite"""

MONTH = """CAST(year(date_vente) AS INTEGER) AS annee, CAST(month(date_vente) AS INTEGER) AS mois,
        strftime(date_vente, '%Y-%m') AS mois_label"""

TABLES: dict[str, str] = {}

# -- bronze -----------------------------------------------------------------

TABLES["bronze_ventes"] = """
    SELECT l_orderkey * 10 + l_linenumber AS vente_id,
        CASE WHEN (l_orderkey + l_partkey) % 211 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date_vente,
        CASE WHEN (l_orderkey + l_partkey) % 307 = 0 THEN NULL ELSE o_custkey END AS client_id,
        l_partkey AS produit_id,
        CAST(o_orderpriority[1:1] AS INTEGER) AS canal_id,
        CAST(CASE l_suppkey % 50 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE l_quantity END AS INTEGER) AS quantite,
        CAST(CASE l_suppkey % 50 WHEN 2 THEN -CAST(l_extendedprice AS DECIMAL(18,2)) WHEN 3 THEN NULL
             ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS montant
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

TABLES["bronze_produits"] = """
    SELECT p_partkey AS produit_id,
        CASE WHEN p_partkey % 47 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN '  ' || p_name || '  ' ELSE p_name END AS nom,
        CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN '  ' ELSE lower(p_type) END AS categorie,
        CAST(CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 0
             ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS prix,
        CASE WHEN p_partkey % 43 = 0 THEN '' ELSE lower(p_brand) END AS marque
    FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 100 = 0)"""

TABLES["bronze_clients"] = f"""
    SELECT c_custkey AS client_id,
        CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE c_name END AS nom,
        CASE WHEN c_custkey % 59 = 0 THEN '' ELSE 'prenom ' || (c_custkey % 17) END AS prenom,
        ([{', '.join(map(text, city_slots()))}])[c_custkey % 32 + 1] AS ville,
        CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE lower(c_mktsegment) END AS segment,
        strftime(DATE '1992-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d') AS date_inscription
    FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 100 = 0)"""

TABLES["bronze_stocks"] = """
    SELECT p_partkey AS produit_id,
        CASE d WHEN 0 THEN 'entrepot nord' WHEN 1 THEN ' Quai Sud ' WHEN 2 THEN 'PLATEFORME EST' END AS depot,
        CAST(CASE p_partkey % 10 WHEN 0 THEN -3 WHEN 1 THEN CASE d WHEN 0 THEN 1 ELSE 0 END
             WHEN 2 THEN 1 WHEN 3 THEN 10 ELSE (p_partkey * 7 + d * 13) % 97 END AS INTEGER) AS quantite_disponible
    FROM (
        SELECT p_partkey, d FROM part, range(4) AS depots(d)
        UNION ALL SELECT p_partkey, 0 FROM part WHERE p_partkey % 100 = 7)"""

TABLES["bronze_retours"] = """
    SELECT l_orderkey * 10 + l_linenumber AS retour_id, l_orderkey * 10 + l_linenumber AS vente_id,
        l_partkey AS produit_id,
        CASE l_suppkey % 6 WHEN 0 THEN 'casse_transport' WHEN 1 THEN 'delai_depasse' WHEN 2 THEN 'article_en_double'
            WHEN 3 THEN 'change_avis' WHEN 4 THEN '' END AS motif,
        CAST(l_shipdate AS DATE) + 10 AS date_retour
    FROM lineitem WHERE l_returnflag = 'R'"""

TABLES["bronze_canaux"] = """
    SELECT CAST(o_orderpriority[1:1] AS INTEGER) AS canal_id,
        CASE o_orderstatus WHEN 'F' THEN ' ' || lower(o_orderpriority[3:]) || ' ' ELSE lower(o_orderpriority[3:]) END AS nom
    FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)
    WHERE o_orderpriority NOT LIKE '5%'"""

# -- silver -----------------------------------------------------------------

TABLES["one_client"] = first_copy("bronze_clients", "client_id", "nom, prenom, ville, segment, date_inscription")
TABLES["one_produit"] = first_copy("bronze_produits", "produit_id", "nom, categorie, prix, marque")
TABLES["one_vente"] = first_copy(
    "bronze_ventes", "vente_id", "date_vente, client_id, produit_id, canal_id, quantite, montant",
    required=("date_vente", "client_id", "produit_id"))
TABLES["one_stock"] = first_copy("bronze_stocks", "produit_id, depot", "quantite_disponible")
TABLES["one_retour"] = first_copy("bronze_retours", "retour_id", "vente_id, produit_id, motif, date_retour")
TABLES["one_canal"] = first_copy("bronze_canaux", "canal_id", "nom")

TABLES["silver_clients"] = f"""
    SELECT *, {region_case('ville')} AS region FROM (
        SELECT client_id,
            upper(trim({blank_as('nom', 'Inconnu')})) AS nom,
            {initcap(f"trim({blank_as('prenom', 'Inconnu')})")} AS prenom,
            {initcap(f"trim({blank_as('ville', 'Inconnu')})")} AS ville,
            upper(trim({blank_as('segment', 'Standard')})) AS segment,
            TRY_CAST(date_inscription AS DATE) AS date_inscription
        FROM one_client)"""

TABLES["silver_produits"] = f"""
    SELECT produit_id,
        trim({blank_as('nom', 'Produit Inconnu')}) AS nom,
        {initcap(f"trim({blank_as('categorie', 'Non classé')})")} AS categorie,
        CASE WHEN prix IS NULL OR prix <= 0 THEN (SELECT quantile_disc(prix, 0.5) FROM bronze_produits) ELSE prix END AS prix,
        {initcap(f"trim({blank_as('marque', 'Inconnue')})")} AS marque
    FROM one_produit"""

TABLES["kept_ventes"] = """
    SELECT vente_id, date_vente, client_id, produit_id, canal_id,
        CASE WHEN quantite IS NULL OR quantite <= 0 THEN 1 ELSE quantite END AS quantite,
        CASE WHEN montant IS NULL OR montant <= 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE montant END AS montant
    FROM one_vente
    WHERE date_vente IS NOT NULL AND client_id IS NOT NULL AND produit_id IS NOT NULL"""

TABLES["silver_ventes"] = f"""
    SELECT v.*, coalesce(upper(trim(c.nom)), 'INCONNU') AS nom_canal,
        coalesce({initcap('trim(p.categorie)')}, 'Non classé') AS categorie_produit,
        p.prix AS prix_unitaire
    FROM kept_ventes v
    LEFT JOIN one_canal c ON v.canal_id = c.canal_id
    LEFT JOIN one_produit p ON v.produit_id = p.produit_id"""

TABLES["silver_stocks"] = f"""
    SELECT produit_id, {initcap(f"trim({blank_as('depot', 'Dépôt Inconnu')})")} AS depot,
        CASE WHEN quantite_disponible IS NULL OR quantite_disponible < 0 THEN 0 ELSE quantite_disponible END AS quantite_disponible
    FROM one_stock"""

TABLES["silver_retours"] = f"""
    SELECT r.retour_id, r.vente_id, r.produit_id,
        {initcap(f"trim({blank_as('motif', 'Non spécifié')})")} AS motif, r.date_retour,
        coalesce(v.montant, 0) AS montant_retour, v.canal_id, v.client_id
    FROM one_retour r LEFT JOIN one_vente v ON r.vente_id = v.vente_id"""

TABLES["silver_canaux"] = """
    SELECT canal_id, CASE WHEN nom IS NULL OR trim(nom) = '' THEN 'INCONNU' ELSE upper(trim(nom)) END AS nom
    FROM one_canal"""

# -- gold -------------------------------------------------------------------

TABLES["gold_ca_daily"] = f"SELECT date_vente, {MEASURES} FROM silver_ventes GROUP BY date_vente"

TABLES["gold_ca_weekly"] = f"""
    SELECT CAST(year(date_vente) AS INTEGER) AS annee, CAST(week(date_vente) AS INTEGER) AS semaine, {MEASURES}
    FROM silver_ventes GROUP BY 1, 2"""

TABLES["gold_ca_monthly"] = f"SELECT {MONTH}, {MEASURES} FROM silver_ventes GROUP BY 1, 2, 3"

TABLES["gold_ca_by_canal"] = f"""
    SELECT canal_id, nom_canal, {MEASURES},
        {rounded("CAST(sum(montant) AS DOUBLE) / (SELECT CAST(sum(montant) AS DOUBLE) FROM silver_ventes) * 100")} AS part_ca_pct
    FROM silver_ventes GROUP BY canal_id, nom_canal"""

TABLES["gold_top_products"] = f"""
    SELECT *, CAST(rank() OVER (ORDER BY total_quantite_vendue DESC) AS INTEGER) AS rang FROM (
        SELECT v.produit_id, nom, categorie, marque, CAST(prix AS DOUBLE) AS prix,
            {whole('sum(quantite)')} AS total_quantite_vendue, {amount('sum(montant)')} AS ca_total,
            count(vente_id) AS nb_transactions,
            {rounded('CAST(sum(montant) AS DOUBLE) / count(montant)')} AS panier_moyen
        FROM silver_ventes v LEFT JOIN silver_produits p ON v.produit_id = p.produit_id
        GROUP BY v.produit_id, nom, categorie, marque, prix
        ORDER BY total_quantite_vendue DESC, v.produit_id LIMIT 10)"""

TABLES["gold_sales_by_region"] = f"""
    SELECT region, ville, {MEASURES}
    FROM silver_ventes v LEFT JOIN silver_clients c ON v.client_id = c.client_id GROUP BY region, ville"""

TABLES["gold_customer_basket"] = f"""
    SELECT v.client_id, nom, prenom, ville, segment, region, count(vente_id) AS nb_achats,
        {amount('sum(montant)')} AS ca_total_client,
        {rounded('CAST(sum(montant) AS DOUBLE) / count(montant)')} AS panier_moyen,
        {whole('sum(quantite)')} AS total_articles
    FROM silver_ventes v LEFT JOIN silver_clients c ON v.client_id = c.client_id
    GROUP BY v.client_id, nom, prenom, ville, segment, region"""

TABLES["gold_return_rate"] = f"""
    SELECT s.produit_id, nb_ventes, ca_total, coalesce(nb_retours, 0) AS nb_retours,
        coalesce(montant_retours, 0.0) AS montant_retours, nom, categorie, marque,
        {rounded('CAST(coalesce(nb_retours, 0) AS DOUBLE) / nb_ventes * 100')} AS taux_retour_pct
    FROM (SELECT produit_id, count(vente_id) AS nb_ventes, {amount('sum(montant)')} AS ca_total
          FROM silver_ventes GROUP BY produit_id) s
    LEFT JOIN (SELECT produit_id, count(retour_id) AS nb_retours, {amount('sum(montant_retour)')} AS montant_retours
          FROM silver_retours GROUP BY produit_id) r ON s.produit_id = r.produit_id
    LEFT JOIN silver_produits p ON s.produit_id = p.produit_id"""

TABLES["gold_sales_by_category"] = f"""
    SELECT {MONTH}, categorie_produit, {amount('sum(montant)')} AS ca_total, count(vente_id) AS nb_ventes,
        {whole('sum(quantite)')} AS total_quantite
    FROM silver_ventes GROUP BY 1, 2, 3, 4"""

TABLES["gold_sales_by_segment"] = f"""
    SELECT segment, {MEASURES}, count(DISTINCT v.client_id) AS nb_clients_actifs
    FROM silver_ventes v LEFT JOIN silver_clients c ON v.client_id = c.client_id GROUP BY segment"""

TABLES["stock_pace"] = f"""
    SELECT h.produit_id, stock_total, coalesce(total_vendu, 0) AS total_vendu,
        coalesce({rounded('CAST(total_vendu AS DOUBLE) / (SELECT greatest(max(date_vente) - min(date_vente), 1) FROM silver_ventes)')}, 0.0)
            AS ventes_par_jour
    FROM (SELECT produit_id, {whole('sum(quantite_disponible)')} AS stock_total FROM silver_stocks GROUP BY produit_id) h
    LEFT JOIN (SELECT produit_id, {whole('sum(quantite)')} AS total_vendu FROM silver_ventes GROUP BY produit_id) s
        ON h.produit_id = s.produit_id"""

TABLES["stock_days"] = f"""
    SELECT *, CASE WHEN ventes_par_jour > 0 THEN {rounded('stock_total / ventes_par_jour', 0)} ELSE 9999.0 END AS jours_de_stock
    FROM stock_pace"""

# The labels and limits of the levels are part of the data contract.
TABLES["gold_stock_alert"] = f"""
    SELECT d.produit_id, stock_total, total_vendu, ventes_par_jour, nom, categorie, marque,
        CAST(prix AS DOUBLE) AS prix, jours_de_stock,
        CASE WHEN stock_total = 0 THEN '🔴 RUPTURE' WHEN jours_de_stock <= 7 THEN '🟠 CRITIQUE'
             WHEN jours_de_stock <= 30 THEN '🟡 FAIBLE' WHEN jours_de_stock >= 365 THEN '🔵 SUR-STOCK'
             ELSE '🟢 NORMAL' END AS alerte,
        {amount('stock_total * prix')} AS valeur_stock
    FROM stock_days d LEFT JOIN silver_produits p ON d.produit_id = p.produit_id"""

TABLES["rfm_raw"] = f"""
    SELECT client_id,
        CAST((SELECT max(date_vente) FROM silver_ventes) - max(date_vente) AS INTEGER) AS recence_jours,
        count(vente_id) AS frequence, round(sum(montant), 2) AS spent
    FROM silver_ventes GROUP BY client_id"""

TABLES["rfm_cuts"] = """
    SELECT quantile_disc(recence_jours, [0.25, 0.5, 0.75]) AS r, quantile_disc(frequence, [0.25, 0.5, 0.75]) AS f,
        quantile_disc(spent, [0.25, 0.5, 0.75]) AS m
    FROM rfm_raw"""

TABLES["rfm_scores"] = """
    SELECT rfm_raw.*,
        CASE WHEN recence_jours <= r[1] THEN 4 WHEN recence_jours <= r[2] THEN 3 WHEN recence_jours <= r[3] THEN 2 ELSE 1 END AS r_score,
        CASE WHEN frequence >= f[3] THEN 4 WHEN frequence >= f[2] THEN 3 WHEN frequence >= f[1] THEN 2 ELSE 1 END AS f_score,
        CASE WHEN spent >= m[3] THEN 4 WHEN spent >= m[2] THEN 3 WHEN spent >= m[1] THEN 2 ELSE 1 END AS m_score
    FROM rfm_raw, rfm_cuts"""

# The labels and limits of the segments are part of the data contract.
TABLES["gold_client_rfm"] = f"""
    SELECT s.client_id, recence_jours, frequence, CAST(spent AS DOUBLE) AS montant_total, r_score, f_score, m_score,
        r_score + f_score + m_score AS rfm_score,
        CASE WHEN r_score + f_score + m_score >= 11 THEN '💎 Champion'
             WHEN r_score + f_score + m_score >= 9 AND r_score >= 3 THEN '⭐ Fidèle'
             WHEN r_score + f_score + m_score >= 9 AND r_score < 3 THEN '😴 A Risque'
             WHEN r_score + f_score + m_score >= 7 THEN '📈 Potentiel'
             WHEN r_score >= 3 THEN '🆕 Nouveau' ELSE '💤 Perdu' END AS rfm_segment,
        nom, prenom, ville, segment, region
    FROM rfm_scores s LEFT JOIN silver_clients c ON s.client_id = c.client_id"""

TABLES["canal_months"] = f"""
    SELECT {MONTH}, canal_id, nom_canal, sum(montant) AS ca, {amount('sum(montant)')} AS ca_total,
        count(vente_id) AS nb_ventes,
        {rounded('CAST(sum(montant) AS DOUBLE) / count(montant)')} AS panier_moyen,
        count(DISTINCT client_id) AS nb_clients_uniques
    FROM silver_ventes GROUP BY 1, 2, 3, 4, 5"""

TABLES["canal_lagged"] = """
    SELECT *, lag(ca) OVER (PARTITION BY canal_id ORDER BY annee, mois) AS before FROM canal_months"""

TABLES["gold_canal_performance"] = f"""
    SELECT annee, mois, mois_label, canal_id, nom_canal, ca_total, nb_ventes, panier_moyen, nb_clients_uniques,
        CAST(before AS DOUBLE) AS ca_mois_precedent,
        CASE WHEN before > 0 THEN {rounded('CAST(ca - before AS DOUBLE) / CAST(before AS DOUBLE) * 100')} END AS croissance_pct
    FROM canal_lagged"""

TABLES["days"] = """
    SELECT date_vente, sum(montant) AS ca, count(vente_id) AS nb_ventes, count(DISTINCT client_id) AS nb_clients_actifs
    FROM silver_ventes GROUP BY date_vente"""


def trend(seven: str, thirty: str) -> str:
    average = lambda w: rounded(f"CAST(sum(ca) OVER ({w}) AS DOUBLE) / count(ca) OVER ({w})")
    return f"""
    SELECT date_vente, CAST(ca AS DOUBLE) AS ca_jour, nb_ventes, nb_clients_actifs,
        {average(seven)} AS moyenne_mobile_7j, {average(thirty)} AS moyenne_mobile_30j,
        CAST(sum(ca) OVER (ORDER BY date_vente ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS ca_cumule
    FROM days"""


TABLES["gold_daily_trend"] = trend(
    "ORDER BY date_vente ROWS 6 PRECEDING", "ORDER BY date_vente ROWS 29 PRECEDING")
TABLES["gold_daily_trend_calendar"] = trend(
    "ORDER BY date_vente RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW",
    "ORDER BY date_vente RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW")


def affinity(counted: str) -> str:
    return f"""
    SELECT a.produit_id AS produit_a, a.categorie_produit AS categorie_a,
        b.produit_id AS produit_b, b.categorie_produit AS categorie_b, {counted} AS nb_clients_communs
    FROM silver_ventes a JOIN silver_ventes b ON a.client_id = b.client_id AND a.produit_id < b.produit_id
    GROUP BY 1, 2, 3, 4 HAVING {counted} >= 2
    ORDER BY nb_clients_communs DESC, produit_a, produit_b, categorie_a NULLS LAST, categorie_b NULLS LAST LIMIT 100"""


TABLES["gold_product_affinity"] = affinity("count(a.client_id)")
TABLES["gold_product_affinity_clients"] = affinity("count(DISTINCT a.client_id)")


def statement(select: str) -> str:
    """``select`` with the WITH clause for all tables it uses, directly or not."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[a-z0-9_]+\b", sql):
            if name in TABLES and name not in needed:
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    clauses = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name]})" for name in needed)
    return f"WITH {clauses}\n{select}"
