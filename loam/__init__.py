"""Catalog analytics on Spark: lineage graphs, edit-log inventories and archival scoring over any assets."""
