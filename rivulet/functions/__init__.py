"""Pure Column functions: they never look at the data and never run a job."""
