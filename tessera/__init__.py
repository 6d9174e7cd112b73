"""tessera: a PySpark-native engagement status and goal-coverage library.

The library reads a set of relational tables, joins them with NULL-safe keys
into a language-engagement dimension, attaches a product fact table, derives a
status for every group of products from ordered rules, rolls those statuses up
to one per engagement by priority, and reports how a list of goal languages is
covered. Everything is expressed with the DataFrame API so Catalyst and AQE
choose the physical plan.
"""

from tessera.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
