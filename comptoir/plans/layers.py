"""All tables of one warehouse as lazy frames, each built once per object."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from comptoir.operators.totals import roll_up, roll_up_clients
from comptoir.plans import gold, silver
from comptoir.plans.watch import Watch
from comptoir.sources.stores import written

BRONZE = ("clients", "produits", "ventes", "stocks", "retours", "canaux")
SILVER = BRONZE
GOLD = (
    "ca_daily", "ca_weekly", "ca_monthly", "ca_by_canal", "top_products", "sales_by_region",
    "customer_basket", "return_rate", "sales_by_category", "sales_by_segment",
    "stock_alert", "client_rfm", "canal_performance", "daily_trend", "product_affinity",
)


# All gold tables but product_affinity can be built from these.
ROLLUPS = {
    "by_day_clients": lambda ventes: roll_up_clients(ventes, "date_vente", "canal_id", "nom_canal"),
    "by_day": lambda ventes: roll_up(ventes, "date_vente", "canal_id", "nom_canal", "categorie_produit"),
    "by_client": lambda ventes: roll_up(ventes, "client_id", days=True),
    "by_product": lambda ventes: roll_up(ventes, "produit_id", days=True),
}


class Tables:
    """Frames by name: ``tables["ventes"]`` or ``tables.ventes``."""

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def counted(self, name: str) -> DataFrame:
        """A frame with as many rows as the table."""
        return self[name]


class StoredTables(Tables):
    """Frames read back through a function from table name to DataFrame."""

    def __init__(self, read):
        self._read = read

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._read(name)


class Bronze(Tables):
    """Wraps any object with one method per bronze table."""

    def __init__(self, source):
        self._source = source
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BRONZE:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = getattr(self._source, name)()
        return self._built[name]


class Silver(Tables):
    """``watches`` has the observers of the tables that are to be observed; ``many_returns`` see ``silver.retours``."""

    def __init__(self, bronze: Tables, watches: dict[str, Watch] | None = None, many_returns: bool = False):
        self._bronze = bronze
        self._watches, self._many_returns = watches or {}, many_returns

    def counted(self, name: str) -> DataFrame:
        return silver.counted_sales(self._bronze.ventes) if name == "ventes" else self[name]

    @cached_property
    def clients(self) -> DataFrame:
        return silver.clients(self._bronze.clients, self._watches.get("clients"))

    @cached_property
    def produits(self) -> DataFrame:
        return silver.produits(self._bronze.produits, watch=self._watches.get("produits"))

    @cached_property
    def ventes(self) -> DataFrame:
        return silver.ventes(self._bronze.ventes, self._bronze.canaux, self._bronze.produits, self._watches.get("ventes"))

    @cached_property
    def stocks(self) -> DataFrame:
        return silver.stocks(self._bronze.stocks, self._watches.get("stocks"))

    @cached_property
    def retours(self) -> DataFrame:
        return silver.retours(self._bronze.retours, self._bronze.ventes, self._watches.get("retours"), self._many_returns)

    @cached_property
    def canaux(self) -> DataFrame:
        return silver.canaux(self._bronze.canaux, self._watches.get("canaux"))


class Gold(Tables):
    """``by_day``, ``by_client`` and the others are stored roll-ups of
    silver_ventes to build from instead of the sales; see ``ROLLUPS``.
    """

    def __init__(self, silver: Tables, by_day=None, by_client=None, by_product=None, by_day_clients=None):
        self._silver = silver
        self._by_day, self._by_client, self._by_product = by_day, by_client, by_product
        self._by_day_clients = by_day_clients

    @property
    def _day_clients(self) -> DataFrame:
        return self._by_day_clients if self._by_day_clients is not None else self._silver.ventes

    @property
    def _day(self) -> DataFrame:
        return self._by_day if self._by_day is not None else self._silver.ventes

    @property
    def _client(self) -> DataFrame:
        return self._by_client if self._by_client is not None else self._silver.ventes

    @property
    def _product(self) -> DataFrame:
        return self._by_product if self._by_product is not None else self._silver.ventes

    def stored_clients(self) -> DataFrame:
        """The roll-up by client, written now if it was not given."""
        if self._by_client is None:
            self._by_client = written(ROLLUPS["by_client"](self._silver.ventes), "by-client")
        return self._by_client

    def stored_products(self) -> DataFrame:
        if self._by_product is None:
            self._by_product = written(ROLLUPS["by_product"](self._silver.ventes), "by-product")
        return self._by_product

    @cached_property
    def ca_daily(self) -> DataFrame:
        return gold.ca_daily(self._day)

    @cached_property
    def ca_weekly(self) -> DataFrame:
        return gold.ca_weekly(self._day)

    @cached_property
    def ca_monthly(self) -> DataFrame:
        return gold.ca_monthly(self._day)

    @cached_property
    def ca_by_canal(self) -> DataFrame:
        return gold.ca_by_canal(self._day)

    @cached_property
    def sales_by_category(self) -> DataFrame:
        return gold.sales_by_category(self._day)

    @cached_property
    def canal_performance(self) -> DataFrame:
        return gold.canal_performance(self._day_clients)

    @cached_property
    def daily_trend(self) -> DataFrame:
        return gold.daily_trend(self._day_clients)

    @cached_property
    def sales_by_region(self) -> DataFrame:
        return gold.sales_by_region(self._client, self._silver.clients)

    @cached_property
    def customer_basket(self) -> DataFrame:
        return gold.customer_basket(self._client, self._silver.clients)

    @cached_property
    def sales_by_segment(self) -> DataFrame:
        return gold.sales_by_segment(self._client, self._silver.clients)

    @cached_property
    def client_rfm(self) -> DataFrame:
        return gold.client_rfm(self.stored_clients(), self._silver.clients)

    @cached_property
    def top_products(self) -> DataFrame:
        return gold.top_products(self._product, self._silver.produits)

    @cached_property
    def return_rate(self) -> DataFrame:
        return gold.return_rate(self._product, self._silver.retours, self._silver.produits)

    @cached_property
    def stock_alert(self) -> DataFrame:
        return gold.stock_alert(self._silver.stocks, self.stored_products(), self._silver.produits)

    @cached_property
    def product_affinity(self) -> DataFrame:
        return gold.product_affinity(self._silver.ventes)


def register_views(tables: Tables, names, prefix: str) -> None:
    """Temporary views such as gold_ca_daily, for use from ``spark.sql``."""
    for name in names:
        tables[name].createOrReplaceTempView(f"{prefix}_{name}")
