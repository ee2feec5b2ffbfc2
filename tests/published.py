"""A published sample of device status and the published results over it."""

# device, type, location, uptime s, uptime h, messages, errors, queue, reconnects, connection
STATUS = [
    ("device_001", "gateway", "warehouse_a", 8027, 7.27, 453, 12, 41, 6, "Online"),
    ("device_002", "camera", "factory_floor_2", 38989, 20.83, 356, 2, 32, 11, "Offline"),
    ("device_003", "sensor", "warehouse_b", 6241, 1.34, 1900, 4, 6, 11, "Offline"),
    ("device_004", "camera", "warehouse_b", 29065, 20.12, 1959, 9, 50, 5, "Offline"),
    ("device_005", "gateway", "warehouse_a", 70755, 18.1, 818, 8, 29, 3, "Online"),
    ("device_006", "sensor", "factory_floor_2", 38238, 23.29, 1380, 15, 24, 4, "Offline"),
    ("device_007", "sensor", "warehouse_a", 15797, 6.11, 1032, 8, 30, 4, "Online"),
    ("device_008", "gateway", "loading_bay", 53723, 1.4, 1217, 12, 23, 12, "Online"),
    ("device_009", "sensor", "office_block", 62879, 6.15, 250, 12, 49, 3, "Offline"),
    ("device_010", "camera", "warehouse_a", 52073, 11.97, 423, 9, 21, 2, "Online"),
    ("device_011", "camera", "factory_floor_1", 16102, 13.9, 625, 15, 37, 3, "Online"),
    ("device_012", "camera", "server_room", 22124, 10.27, 1916, 15, 33, 11, "Online"),
    ("device_013", "sensor", "factory_floor_2", 11324, 18.65, 716, 13, 19, 11, "Online"),
    ("device_014", "controller", "server_room", 23341, 1.84, 1611, 13, 0, 4, "Online"),
    ("device_015", "sensor", "loading_bay", 77316, 19.28, 1317, 15, 20, 10, "Online"),
]

# device: avg cpu, max cpu, avg temperature, anomalies, published score, tier number, rank
RELIABILITY = {
    "device_007": (8.7, 50.9, 42.3, 4, 86.0, 1, 1), "device_005": (28.2, 62.2, 52.3, 7, 83.5, 2, 2),
    "device_014": (18.8, 51.3, 48.4, 6, 83.0, 2, 3), "device_001": (28.4, 67.0, 52.2, 6, 79.0, 2, 4),
    "device_011": (65.4, 97.5, 61.3, 4, 73.0, 2, 5), "device_010": (65.3, 99.0, 61.3, 6, 72.0, 2, 6),
    "device_008": (28.6, 70.9, 52.1, 7, 69.5, 3, 7), "device_015": (8.8, 48.2, 42.7, 7, 69.5, 3, 7),
    "device_013": (9.2, 44.2, 42.6, 9, 66.5, 3, 9), "device_006": (8.4, 41.2, 42.3, 5, 64.5, 3, 10),
    "device_012": (65.2, 99.0, 61.4, 5, 57.5, 3, 11), "device_009": (9.0, 47.9, 42.8, 12, 56.0, 3, 12),
    "device_003": (8.9, 48.9, 42.5, 8, 48.0, 4, 13), "device_004": (65.7, 96.2, 61.5, 7, 44.5, 4, 14),
    "device_002": (65.5, 94.2, 61.2, 6, 36.0, 4, 15),
}

# udi, tool wear, torque, power, temperature gap, published score, rank
RISK = [
    (352, 250, 52.8, 9.0, 8.4, 99.5, 1), (1304, 250, 54.5, 8.0, 7.8, 99.5, 1), (5130, 250, 52.1, 9.0, 8.4, 99.5, 1),
    (6539, 247, 57.3, 9.0, 7.7, 99.1, 4), (3155, 246, 51.7, 8.0, 8.3, 98.9, 5), (3244, 245, 51.2, 9.0, 8.0, 98.7, 6),
    (3758, 244, 50.4, 9.0, 8.5, 98.6, 7), (3349, 241, 59.6, 9.0, 8.0, 98.1, 8), (60, 240, 56.9, 7.0, 8.5, 97.9, 9),
    (7748, 239, 54.0, 10.0, 7.2, 97.8, 10), (2328, 238, 54.0, 7.0, 7.6, 97.6, 11), (3513, 234, 55.9, 9.0, 8.3, 97.0, 12),
    (4912, 232, 55.6, 9.0, 8.1, 96.7, 13), (2101, 223, 62.4, 9.0, 8.3, 95.3, 14), (1464, 220, 60.6, 8.0, 8.5, 94.8, 15),
]
