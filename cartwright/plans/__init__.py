"""The data marts: sales tables, product report, daily rollup."""
