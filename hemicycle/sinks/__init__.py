"""Writers: lineage columns, partitioned tables, manifests and exports."""
