"""Reading sources and layers, stamping lineage, writing layers."""
