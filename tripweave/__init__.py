"""tripweave: customer analytics for travel bookings, written as Spark DataFrame transformations."""

__version__ = "0.1.0"
