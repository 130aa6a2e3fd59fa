"""Statistical tabulation with privacy protection, as Spark jobs."""
