"""betaloom: cytosine-methylation analytics as Spark DataFrame jobs."""
