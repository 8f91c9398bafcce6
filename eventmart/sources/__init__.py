"""Reading raw event files and landing batches."""
