"""Link-graph analytics over request catalogues and analytics over long climate grids, on Spark DataFrames."""
