"""DataFrame-to-DataFrame operators over records, datapoints and documents."""
