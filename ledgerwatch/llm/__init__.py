"""Training-data pipeline operators. Nothing else in the library imports this
package; ``__spark_entry__`` registers its queries only when it is present."""
