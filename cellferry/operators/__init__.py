"""DataFrame to DataFrame steps. Only the steps that say so start a job."""
