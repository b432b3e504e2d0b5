"""Claims star schema, marts, quality checks and refresh jobs as Spark jobs."""
