"""The DuckDB statement for each registered query."""

from __future__ import annotations

from comptoir.oracle.tables import (
    TABLES, amount, blank_as, initcap, mean, region_case, rounded, statement, text, whole,
)


def total(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,2))) AS DOUBLE)"


SELECTS: dict[str, str] = {}

# Money is DECIMAL in bronze and silver; it is compared as DOUBLE.
DECIMALS = {
    "bronze_ventes": ["montant"], "bronze_produits": ["prix"],
    "silver_ventes": ["montant", "prix_unitaire"], "silver_produits": ["prix"],
    "silver_retours": ["montant_retour"],
}
for _name in TABLES:
    if _name.startswith(("bronze_", "silver_", "gold_")):
        _casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS.get(_name, []))
        SELECTS[_name] = f"SELECT *{f' REPLACE ({_casts})' if _casts else ''} FROM {_name}"

# -- reports --------------------------------------------------------------------

SELECTS["q_daily_last30"] = """
    SELECT date_vente, ca_total, nb_ventes, panier_moyen, total_quantite FROM gold_ca_daily
    ORDER BY date_vente DESC LIMIT 30"""
SELECTS["q_monthly"] = "SELECT * EXCLUDE (annee, mois) FROM gold_ca_monthly"
SELECTS["q_monthly_desc"] = """
    SELECT annee, mois, mois_label, ca_total AS ca_mensuel, nb_ventes FROM gold_ca_monthly"""
SELECTS["q_weekly"] = "SELECT * EXCLUDE (total_quantite) FROM gold_ca_weekly"
SELECTS["q_global_totals"] = f"""
    SELECT {total('ca_total')} AS ca_global, {whole('sum(nb_ventes)')} AS total_ventes,
        {mean('panier_moyen')} AS panier_moyen_global FROM gold_ca_monthly"""
SELECTS["q_by_channel"] = "SELECT * EXCLUDE (canal_id) FROM gold_ca_by_canal"
SELECTS["q_channel_growth"] = """
    SELECT nom_canal, mois_label, ca_total, nb_ventes, nb_clients_uniques, croissance_pct FROM gold_canal_performance"""
SELECTS["q_top10_products"] = """
    SELECT * EXCLUDE (produit_id, panier_moyen) FROM gold_top_products WHERE rang <= 10"""
SELECTS["q_category_month"] = "SELECT * EXCLUDE (annee, mois) FROM gold_sales_by_category"
SELECTS["q_region"] = f"""
    SELECT region, {total('ca_total')} AS ca_region, {whole('sum(nb_ventes)')} AS nb_ventes,
        {mean('panier_moyen')} AS panier_moyen FROM gold_sales_by_region GROUP BY region"""
SELECTS["q_city_top10"] = """
    SELECT * EXCLUDE (total_quantite) FROM gold_sales_by_region
    ORDER BY ca_total DESC, region NULLS LAST, ville NULLS LAST LIMIT 10"""
SELECTS["q_client_top20"] = """
    SELECT * EXCLUDE (client_id, region) FROM gold_customer_basket
    ORDER BY ca_total_client DESC, client_id NULLS LAST LIMIT 20"""
SELECTS["q_segment_share"] = f"""
    SELECT * EXCLUDE (total_quantite),
        {rounded(f"ca_total / (SELECT {total('ca_total')} FROM gold_sales_by_segment) * 100")} AS part_pct
    FROM gold_sales_by_segment"""
SELECTS["q_rfm_summary"] = f"""
    SELECT rfm_segment, count(*) AS nb_clients, {mean('montant_total')} AS panier_moyen,
        {mean('recence_jours', 0)} AS recence_moyenne_jours, {mean('frequence', 1)} AS frequence_moyenne,
        {total('montant_total')} AS ca_segment
    FROM gold_client_rfm GROUP BY rfm_segment"""
SELECTS["q_champions"] = """
    SELECT nom, prenom, ville, region, recence_jours, frequence, montant_total, rfm_score, rfm_segment
    FROM gold_client_rfm WHERE rfm_segment = '💎 Champion'"""
SELECTS["q_winback"] = """
    SELECT nom, prenom, ville, recence_jours, frequence, montant_total, rfm_segment
    FROM gold_client_rfm WHERE rfm_segment IN ('😴 A Risque', '💤 Perdu')"""
SELECTS["q_return_top10"] = """
    SELECT * EXCLUDE (produit_id, ca_total) FROM gold_return_rate WHERE nb_retours > 0
    ORDER BY taux_retour_pct DESC, produit_id LIMIT 10"""
SELECTS["q_return_top20"] = """
    SELECT nom, categorie, nb_ventes, nb_retours, taux_retour_pct FROM gold_return_rate
    ORDER BY taux_retour_pct DESC, produit_id LIMIT 20"""
SELECTS["q_return_category"] = f"""
    SELECT categorie, {whole('sum(nb_ventes)')} AS total_ventes, {whole('sum(nb_retours)')} AS total_retours,
        {rounded('CAST(sum(nb_retours) AS DOUBLE) / sum(nb_ventes) * 100')} AS taux_retour_pct,
        {total('montant_retours')} AS montant_total_retours
    FROM gold_return_rate GROUP BY categorie"""
SELECTS["q_stock_critical"] = """
    SELECT nom, categorie, marque, stock_total, ventes_par_jour, jours_de_stock, alerte, valeur_stock
    FROM gold_stock_alert WHERE alerte IN ('🔴 RUPTURE', '🟠 CRITIQUE')"""
SELECTS["q_stock_summary"] = f"""
    SELECT alerte, count(*) AS nb_produits, {whole('sum(stock_total)')} AS stock_total,
        {total('valeur_stock')} AS valeur_totale
    FROM gold_stock_alert GROUP BY alerte"""
SELECTS["q_trend_last90"] = "SELECT * FROM gold_daily_trend ORDER BY date_vente DESC LIMIT 90"
SELECTS["q_affinity_top20"] = """
    SELECT * FROM gold_product_affinity
    ORDER BY nb_clients_communs DESC, produit_a, produit_b, categorie_a NULLS LAST, categorie_b NULLS LAST LIMIT 20"""
SELECTS["q_exec_row"] = f"""
    SELECT {total('ca_total')} AS ca_global, {whole('sum(nb_ventes)')} AS total_commandes,
        {mean('panier_moyen')} AS panier_moyen_global, max(ca_total) AS meilleur_mois_ca,
        min(ca_total) AS moins_bon_mois_ca FROM gold_ca_monthly"""
SELECTS["q_exec_long"] = f"""
    SELECT 'CA Total' AS indicateur, CAST(sum(CAST(ca_total AS DECIMAL(28,2))) AS VARCHAR) AS valeur FROM gold_ca_monthly
    UNION ALL SELECT 'Nb Ventes', CAST(sum(nb_ventes) AS VARCHAR) FROM gold_ca_monthly
    UNION ALL SELECT 'Panier Moyen', CAST(CAST({mean('panier_moyen')} AS DECIMAL(18,2)) AS VARCHAR) FROM gold_customer_basket
    UNION ALL SELECT 'Taux Retour %', CAST(CAST({mean('taux_retour_pct')} AS DECIMAL(18,2)) AS VARCHAR) FROM gold_return_rate"""

# -- charts ---------------------------------------------------------------------

SELECTS["d_monthly_ca"] = f"SELECT mois_label, {total('ca_total')} AS ca_total FROM gold_ca_monthly GROUP BY mois_label"
SELECTS["d_channel_ca"] = f"SELECT nom_canal, {total('ca_total')} AS ca_total FROM gold_ca_by_canal GROUP BY nom_canal"
SELECTS["d_top_products"] = f"""
    SELECT nom, {whole('sum(total_quantite_vendue)')} AS total_quantite_vendue FROM gold_top_products GROUP BY nom"""
SELECTS["d_region_ca"] = f"SELECT region, {total('ca_total')} AS ca_total FROM gold_sales_by_region GROUP BY region"
SELECTS["d_return_by_name"] = """
    SELECT nom, max(taux_retour_pct) AS taux_retour_pct FROM gold_return_rate WHERE nb_retours > 0
    GROUP BY nom ORDER BY taux_retour_pct DESC, nom NULLS LAST LIMIT 10"""
SELECTS["d_rfm_pie"] = "SELECT rfm_segment, count(client_id) AS nb_clients FROM gold_client_rfm GROUP BY rfm_segment"
SELECTS["d_trend_series"] = """
    SELECT date_vente, ca_jour, moyenne_mobile_7j, moyenne_mobile_30j FROM gold_daily_trend"""
SELECTS["d_stock_table"] = """
    SELECT nom, categorie, stock_total, jours_de_stock, alerte FROM gold_stock_alert
    WHERE alerte IN ('🔴 RUPTURE', '🟠 CRITIQUE')"""
SELECTS["d_segment"] = f"""
    SELECT segment, {total('ca_total')} AS ca_total, {whole('sum(nb_clients_actifs)')} AS nb_clients_actifs
    FROM gold_sales_by_segment GROUP BY segment"""
SELECTS["d_kpi_tiles"] = f"""
    SELECT (SELECT {total('ca_total')} FROM gold_ca_monthly) AS ca_global,
        {whole('sum(nb_ventes)')} AS total_commandes, {mean('panier_moyen')} AS panier_moyen FROM gold_ca_daily"""
SELECTS["d_region_city"] = f"""
    SELECT region, ville, {total('ca_total_client')} AS ca_total FROM gold_customer_basket GROUP BY region, ville"""
SELECTS["d_basket_segment"] = f"""
    SELECT segment, {mean('panier_moyen')} AS panier_moyen FROM gold_customer_basket GROUP BY segment"""
SELECTS["d_category_line"] = f"""
    SELECT mois_label, categorie_produit, {total('ca_total')} AS ca_total
    FROM gold_sales_by_category GROUP BY mois_label, categorie_produit"""

# -- single rules and operators ---------------------------------------------------

SELECTS["clean_blank_default"] = f"""
    SELECT client_id, {blank_as('ville', 'Inconnu')} AS ville, {blank_as('segment', 'Standard')} AS segment,
        {blank_as('nom', 'Inconnu')} AS nom, {blank_as('prenom', 'Inconnu')} AS prenom FROM bronze_clients"""
SELECTS["clean_numeric_default"] = """
    SELECT vente_id, CASE WHEN quantite > 0 THEN quantite ELSE 1 END AS quantite,
        CAST(CASE WHEN montant > 0 THEN montant ELSE 0 END AS DOUBLE) AS montant FROM bronze_ventes"""
SELECTS["clean_price_median"] = """
    SELECT produit_id, CAST(CASE WHEN prix > 0 THEN prix
        ELSE (SELECT quantile_disc(prix, 0.5) FROM bronze_produits) END AS DOUBLE) AS prix
    FROM bronze_produits"""
SELECTS["fn_text_normalise"] = f"""
    SELECT client_id, {initcap('trim(ville)')} AS ville, upper(trim(segment)) AS segment, trim(prenom) AS prenom
    FROM bronze_clients"""
SELECTS["fn_to_date"] = f"""
    SELECT client_id, TRY_CAST(date_inscription AS DATE) AS date_inscription, TRY_CAST(ville AS DATE) AS not_a_date
    FROM bronze_clients"""
SELECTS["fn_date_parts"] = """
    SELECT date_vente, CAST(year(date_vente) AS INTEGER) AS annee, CAST(week(date_vente) AS INTEGER) AS semaine,
        CAST(month(date_vente) AS INTEGER) AS mois, strftime(date_vente, '%Y-%m') AS mois_label, count(*) AS n
    FROM bronze_ventes WHERE date_vente IS NOT NULL GROUP BY ALL"""
SELECTS["fn_round"] = f"""
    SELECT produit_id, {rounded('CAST(sum(montant) AS DOUBLE) / nullif(sum(quantite), 0)')} AS prix_moyen,
        {rounded('CAST(sum(montant) AS DOUBLE) / nullif(sum(quantite), 0)', 0)} AS prix_entier,
        {rounded('CAST(sum(quantite) AS DOUBLE) / count(*) * 100')} AS quantite_pct
    FROM bronze_ventes GROUP BY produit_id"""
SELECTS["enrich_region"] = f"""
    SELECT client_id, {initcap('trim(ville)')} AS ville, {region_case(initcap('trim(ville)'))} AS region FROM bronze_clients"""
SELECTS["filter_invalid_sales"] = """
    SELECT * REPLACE (CAST(montant AS DOUBLE) AS montant) FROM kept_ventes"""
SELECTS["dedup_sales"] = """
    SELECT * REPLACE (CAST(montant AS DOUBLE) AS montant) FROM one_vente"""
SELECTS["join_sales_channel"] = """
    SELECT vente_id, v.canal_id, coalesce(upper(trim(nom)), 'INCONNU') AS nom_canal
    FROM bronze_ventes v LEFT JOIN one_canal c ON v.canal_id = c.canal_id"""
SELECTS["join_sales_product"] = f"""
    SELECT vente_id, v.produit_id, coalesce({initcap('trim(categorie)')}, 'Non classé') AS categorie_produit,
        CAST(prix AS DOUBLE) AS prix_unitaire
    FROM bronze_ventes v LEFT JOIN one_produit p ON v.produit_id = p.produit_id"""
SELECTS["join_returns_sales"] = """
    SELECT retour_id, r.vente_id, CAST(coalesce(montant, 0) AS DOUBLE) AS montant_retour, canal_id, client_id
    FROM bronze_retours r LEFT JOIN one_vente v ON r.vente_id = v.vente_id"""
SELECTS["agg_quartiles"] = """
    SELECT CAST(i AS INTEGER) AS quartile, r[i] AS recence, f[i] AS frequence, CAST(m[i] AS DOUBLE) AS montant
    FROM rfm_cuts, range(1, 4) AS steps(i)"""
SELECTS["gold_status_counts"] = " UNION ALL ".join(
    f"SELECT {text(t)} AS \"table\", {text(s)} AS statut, count(*) FILTER (WHERE {c} = {text(s)}) AS nb FROM {t}"
    for t, c, s in [
        ("gold_stock_alert", "alerte", "🔴 RUPTURE"), ("gold_stock_alert", "alerte", "🟠 CRITIQUE"),
        ("gold_client_rfm", "rfm_segment", "💎 Champion"), ("gold_client_rfm", "rfm_segment", "💤 Perdu")])
SELECTS["quality_report"] = " UNION ALL ".join(
    f"SELECT {text(t)} AS \"table\", (SELECT count(*) FROM bronze_{t}) AS bronze, (SELECT count(*) FROM silver_{t}) AS silver,"
    f" (SELECT count(*) FROM bronze_{t}) - (SELECT count(*) FROM silver_{t}) AS removed"
    for t in ["clients", "produits", "ventes", "stocks", "retours", "canaux"])

BLANK = {"clients": ["ville", "segment", "nom", "prenom"], "produits": ["categorie", "marque", "nom"],
         "stocks": ["depot"], "retours": ["motif"], "canaux": ["nom"]}
CELLS = {
    "produits": ["prix IS NULL OR prix <= 0"], "stocks": ["quantite_disponible IS NULL"],
    "ventes": ["montant IS NULL OR montant <= 0", "quantite IS NULL OR quantite <= 0"]}
SELECTS["cleaning_report"] = " UNION ALL ".join(f"""
    SELECT {text(t)} AS "table", (SELECT count(*) FROM bronze_{t}) AS read, (SELECT count(*) FROM bronze_{t}) - count(*) AS duplicate,
        {whole(' + '.join([f"count_if(coalesce(trim({c}), '') = '')" for c in BLANK.get(t, [])] + [f"count_if({c})" for c in CELLS.get(t, [])]))} AS defaulted,
        {whole("count_if(quantite_disponible < 0)" if t == "stocks" else "0")} AS clamped,
        {whole("count_if(date_vente IS NULL OR client_id IS NULL OR produit_id IS NULL)" if t == "ventes" else "0")} AS dropped,
        (SELECT count(*) FROM silver_{t}) AS written FROM {one}"""
    for t, one in [("clients", "one_client"), ("produits", "one_produit"), ("ventes", "one_vente"),
                   ("stocks", "one_stock"), ("retours", "one_retour"), ("canaux", "one_canal")])

# -- sources and sinks --------------------------------------------------------------

SELECTS["bronze_audit"] = """
    SELECT produit_id, nullif(nom, '') AS nom, nullif(categorie, '') AS categorie, CAST(prix AS DOUBLE) AS prix,
        nullif(marque, '') AS marque,  -- CSV does not tell an empty text from none
        'part.csv' AS _source_file, 'bronze' AS _layer FROM bronze_produits"""
SELECTS["src_csv_roundtrip"] = SELECTS["bronze_ventes"]
SELECTS["src_csv_other_layout"] = SELECTS["bronze_ventes"]
SELECTS["src_csv_quarantine"] = """
    SELECT vente_id, CASE WHEN kind > 2 THEN montant::DOUBLE END AS montant,
        CASE kind WHEN 0 THEN 'fewer cells than the header' WHEN 1 THEN 'more cells than the header'
            WHEN 2 THEN 'broken quote' END AS reason,
        CASE kind WHEN 0 THEN whole - 1 - coalesce(length(montant::VARCHAR), 0) WHEN 1 THEN whole + 5 WHEN 2 THEN whole + 1 END::INTEGER AS length
    FROM (SELECT *, vente_id % 97 AS kind, 6 + length(concat(vente_id, date_vente, client_id, produit_id, canal_id, quantite, montant)) AS whole
          FROM bronze_ventes)"""
SELECTS["sink_overwrite_roundtrip"] = "SELECT *, 'silver' AS _layer FROM silver_clients"
SELECTS["sink_published_set"] = """
    SELECT 'client' AS kind, client_id AS id, nom FROM silver_clients
    UNION ALL SELECT 'produit', produit_id, nom FROM silver_produits"""
SELECTS["sink_bucketed_basket"] = SELECTS["gold_customer_basket"]
SELECTS["sink_partitioned_pruned_read"] = """
    SELECT date_vente, count(*) AS n, CAST(sum(montant) AS DOUBLE) AS montant FROM silver_ventes
    WHERE date_vente >= DATE '1998-01-01' AND date_vente < DATE '1998-04-01' GROUP BY date_vente"""
SELECTS["landing_manifest"] = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file, '{d}/{t}.parquet' AS destination, true AS found, count(*) AS n FROM {t}"
    for t, d in [("customer", "raw/clients"), ("part", "raw/produits"), ("lineitem", "raw/ventes"),
                 ("orders", "raw/canaux")]
) + "".join(f" UNION ALL SELECT '{t}.parquet', 'raw/{t}/{t}.parquet', false, 0" for t in ("stocks", "retours"))


SELECTS["catalog_tables"] = " UNION ALL ".join(
    f"SELECT 'silver_{t}' AS \"table\", count(*) AS n FROM silver_{t}" for t in ["clients", "produits", "ventes", "stocks", "retours", "canaux"])


def oracle_sql() -> dict[str, str]:
    return {name: statement(select) for name, select in SELECTS.items()}
