"""Multi-channel retail analytics as lazy Spark plans, in three layers.

bronze  raw tables plus lineage columns          (``comptoir.sources``)
silver  cleaned, deduplicated, enriched tables   (``comptoir.plans.silver``)
gold    fifteen aggregate tables                 (``comptoir.plans.gold``)

Reports over gold live in ``comptoir.plans.serving`` and
``comptoir.plans.dashboards``; ``comptoir.plans.runner`` writes the layers.
"""
