"""Query catalogue: ``QUERIES`` (name -> callable) and ``ORACLES`` (name -> DuckDB SQL) of each module."""
