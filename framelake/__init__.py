"""framelake: vehicle-camera frame analytics as Spark DataFrame operators."""
