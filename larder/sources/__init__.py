"""Reading and writing: landing files, layer tables, partitioned folders."""
