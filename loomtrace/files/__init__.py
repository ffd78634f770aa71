"""Files of office programs, pictures and archives read from their bytes: plain Python that runs inside Arrow batches."""
