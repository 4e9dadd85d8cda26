"""Query catalogue: each module offers QUERIES (name -> callable) and ORACLES (name -> SQL)."""
